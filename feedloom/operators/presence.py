"""Distinct counts that add up: who was there, as bitmaps.

A distinct count of two days is not the sum of their counts, but the union of who was there is.  Each group of a
day keeps the numbers of its members as bitmaps of 32,768 bits, and counts over any days come from their unions,
without going back to the rows.  Numbers are dense: members are numbered in a table of their own, new ones behind
those there are, so that bitmaps stay full.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.joins import new_rows
from feedloom.operators.ranks import with_position


def number_members(members: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """``column, number`` of the members ``known`` lacks: numbers follow the largest there is, from 0."""
    fresh = members.select(column).where(F.col(column).isNotNull()).distinct()
    if known is None:
        return with_position(fresh, [], [column], "number").withColumn("number", F.col("number") - 1)
    last = known.agg(F.coalesce(F.max("number"), F.lit(-1))).scalar()
    return with_position(new_rows(fresh, known, column), [], [column], "number").withColumn("number", F.col("number") + last)


def presence(rows: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """``by, part, bits``: a bitmap of the numbers of each group; rows without a number are in none."""
    numbered = rows.where(F.col(number).isNotNull())
    place = F.bitmap_bit_position(F.col(number)).alias("_at")
    placed = numbered.select(*by, F.bitmap_bucket_number(F.col(number)).alias("part"), place)
    return placed.groupBy(*by, "part").agg(F.bitmap_construct_agg("_at").alias("bits"))


def union_presence(found: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of fewer, larger groups."""
    return found.groupBy(*by, "part").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_presence(found: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """How many members each group has, each counted once."""
    return union_presence(found, by).groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
