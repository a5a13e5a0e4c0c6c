"""Joins.

None carries a broadcast hint: the planner broadcasts a side when its size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, and adaptive
execution splits the partitions a hot key makes too large.  Keys can also be found hot
and spread beforehand (``hot_keys``), which needs no threshold in bytes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import after_sep


SALTS = 256
HOT_SHARE = 0.01
TRACKED = 4096  # keys that a task's sketch holds at a time


def hot_keys(df: DataFrame, on: str, share: float = HOT_SHARE) -> Column:
    """The keys that hold at least ``share`` of the rows, as an array, found by a mergeable top-k sketch.

    There are at most ``1 / share`` of them.  The sketch counts a key too high by its error at most, never too low,
    so none is missed; it is read in one pass over the key and evaluated with the query that uses it.
    """
    ceiling = int(1 / share) + 1
    counted = df.where(F.col(on).isNotNull()).agg(
        F.expr(f"approx_top_k(`{on}`, {ceiling}, {max(TRACKED, ceiling)})").alias("top"), F.count(F.lit(1)).alias("n"),
    )
    often = F.filter("top", lambda entry: entry["count"] >= F.lit(share) * F.col("n"))
    return counted.select(F.transform(often, lambda entry: entry["item"])).scalar()


def left_join_salted(fact: DataFrame, dim: DataFrame, on: str, hot: Sequence[str] | Column, salts: int = SALTS) -> DataFrame:
    """Left join in which the facts of hot keys are spread over ``salts`` tasks.

    ``hot`` names keys (sentinels) or is what ``hot_keys`` found.  Each hot key's rows of the dimension, few by
    nature, are repeated once per salt; all other keys have salt 0.  Which salt a fact gets depends on its content alone.
    """
    return left_joins_salted(fact, [dim], on, hot, salts)


def left_joins_salted(fact: DataFrame, dims: Sequence[DataFrame], on: str, hot: Sequence[str] | Column, salts: int = SALTS) -> DataFrame:
    """``left_join_salted`` to several dimensions by one key: the salt is the same for all, so facts are shuffled once."""
    if isinstance(hot, Column):
        is_hot = F.coalesce(F.array_contains(hot, F.col(on)), F.lit(False))
    elif hot:
        is_hot = F.coalesce(F.col(on).isin(*hot), F.lit(False))
    else:
        for dim in dims:
            fact = fact.join(dim, on, "left")
        return fact
    spread = F.when(is_hot, F.pmod(F.xxhash64(*fact.columns), F.lit(salts))).otherwise(F.lit(0))
    copies = F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    left = fact.withColumn("_salt", spread.cast("int"))
    for dim in dims:
        left = left.join(dim.withColumn("_salt", copies), [on, "_salt"], "left")
    return left.drop("_salt")


def join_current(
    fact: DataFrame, dim: DataFrame, on: str, end_column: str, columns: Sequence[str], hot: Sequence[str] | Column = ()
) -> DataFrame:
    """Left join to the open version of a dimension; a fact without one stays.  For ``hot`` see ``left_join_salted``."""
    current = dim.where(F.col(end_column).isNull()).select(on, *columns)
    return left_join_salted(fact, current, on, hot)


def latest_per_key(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    newest = df.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_row"))
    return newest.select(key, "_row.*")


def join_latest(
    fact: DataFrame, dim: DataFrame, on: str, order: Sequence[str], columns: Sequence[str], hot: Sequence[str] | Column = ()
) -> DataFrame:
    return left_join_salted(fact, latest_per_key(dim, on, order, columns), on, hot)


def enrich_priority(
    fact: DataFrame,
    inner: DataFrame,
    on: str,
    lefts: Sequence[tuple[DataFrame, str]],
    choices: Mapping[str, Sequence[str]],
    hot: Sequence[str] | Column = (),
) -> DataFrame:
    """Inner join, left joins, then for each new column the first filled choice.

    A left table brings its own columns under names that do not clash; its rows are
    expected to be filtered already (the filter belongs to the join, not the result).
    """
    joined = fact.join(inner, on, "inner")
    for key, tables in groupby(lefts, lambda left: left[1]):
        joined = left_joins_salted(joined, [table for table, _ in tables], key, hot)
    return joined.withColumns({
        name: F.coalesce(*[F.col(c) for c in columns]) for name, columns in choices.items()
    })


def new_rows(source: DataFrame, target: DataFrame, key: str, target_key: str | None = None) -> DataFrame:
    """Source rows whose key the target lacks; a null key is never found, so it stays.

    The target is first reduced to the keys the source has.  With a small source that
    is a broadcast filter over one column of the target, and the target never shuffles.
    """
    wanted = source.select(key).distinct()
    known = target.select(F.col(target_key or key).alias(key)).join(wanted, key, "left_semi").distinct()
    return source.join(known, key, "left_anti")


def not_in(source: DataFrame, target: DataFrame, key: str, target_key: str | None = None) -> DataFrame:
    """SQL ``NOT IN (SELECT …)``: one null on the right leaves no row, an empty right all.

    Spark runs that predicate by broadcasting the right side whatever its size, so the
    two special cases are looked up as scalars and the rest is an ordinary anti join.
    """
    right = target.select(F.col(target_key or key).alias(key))
    empty = right.agg(F.count(F.lit(1)) == 0).scalar()
    has_null = right.agg(F.coalesce(F.max(F.col(key).isNull()), F.lit(False))).scalar()
    unmatched = source.join(right.where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return unmatched.where(empty | (~has_null & F.col(key).isNotNull()))


def match_by_suffix(
    events: DataFrame, title: str, day: Column, probe: DataFrame, probe_title: str, probe_day: Column,
    separator: str = " X ", require_suffix: bool = False,
) -> DataFrame:
    """Events of the probe's day whose title is LIKE what follows the separator in the probe's
    title, with anything before and after.  ``%`` and ``_`` in the suffix are wildcards, as in
    the SQL predicate.  The probe is a single row, read as scalars: no join takes place.

    A title without the separator gives an empty suffix, which every event of the day
    matches; ``require_suffix`` turns that into no match.
    """
    suffix = probe.select(F.upper(after_sep(probe_title, separator))).scalar()
    when = probe.select(probe_day).scalar()
    pattern = F.concat(F.lit("%"), suffix, F.lit("%"))
    matched = events.where((day == when) & F.like(F.upper(F.col(title)), pattern, F.lit("\x01")))  # no escapes
    return matched.where(suffix != "") if require_suffix else matched


def _grams(text: Column, size: int) -> Column:
    """The different runs of ``size`` characters of a text."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    found = F.array_distinct(F.transform(starts, lambda at: F.substring(text, at, F.lit(size))))
    return F.when(F.length(text) >= size, found).otherwise(F.array().cast("array<string>"))


def match_suffixes(
    events: DataFrame, key: str, title: str, day: Column, probes: DataFrame, probe_title: str, probe_day: Column,
    separator: str = " X ", require_suffix: bool = False, size: int = 3,
) -> DataFrame:
    """``match_by_suffix`` for a table of probes: each probe's columns with the ``key`` of each event it matches.

    An inverted index has the ``size``-grams of the different titles of each day.  A probe is looked up by the gram of its
    suffix that the fewest titles of its day hold, wildcards cutting the suffix into pieces; what that finds is
    tested with LIKE, in full.  A suffix that has no gram, being short or all wildcards, meets the titles of its
    day.  Events, which may be many of one title, come in only when it is known which titles match.  Probes with
    the same columns count as one.
    """
    titled = events.select(F.col(key).alias("_key"), day.alias("_on"), F.upper(F.col(title)).alias("_title")).where("_on is not null and _title is not null")
    titles = titled.select("_on", "_title").distinct()
    suffix = F.upper(after_sep(probe_title, separator))
    asked = probes.select(*probes.columns, suffix.alias("_suffix"), probe_day.alias("_on")).distinct().where("_on is not null and _suffix is not null")
    asked = asked.where("_suffix <> ''") if require_suffix else asked
    pieces = F.split("_suffix", "[%_]+")
    asked = asked.withColumn("_grams", F.array_distinct(F.flatten(F.transform(pieces, lambda piece: _grams(piece, size)))))
    index = titles.select("_on", "_title", F.explode(_grams(F.col("_title"), size)).alias("_gram"))
    held = index.groupBy("_on", "_gram").agg(F.count(F.lit(1)).alias("_n"))
    wanted = asked.select("_on", "_suffix", F.size("_grams").alias("_all"), F.explode("_grams").alias("_gram")).distinct()
    met = wanted.join(held, ["_on", "_gram"]).groupBy("_on", "_suffix", "_all")
    rarest = met.agg(F.count(F.lit(1)).alias("_found"), F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram"))
    # a gram that no title of the day holds rules the suffix out
    chosen = rarest.where("_found = _all").select("_on", "_gram", "_suffix")
    pattern = F.concat(F.lit("%"), F.col("_suffix"), F.lit("%"))
    like = F.like(F.col("_title"), pattern, F.lit("\x01"))  # no escapes
    near = chosen.join(index, ["_on", "_gram"]).where(like)
    plain = asked.where(F.size("_grams") == 0).select("_on", "_suffix").distinct().join(titles, "_on").where(like)
    pairs = near.select("_on", "_suffix", "_title", "_gram").unionByName(plain.select("_on", "_suffix", "_title", F.lit(None).cast("string").alias("_gram")))
    found = asked.join(pairs, ["_on", "_suffix"]).select(*probes.columns, "_on", "_title", "_gram")
    # events found by a gram: none without a key, and one that shares its key and day as often as those hold the gram
    keyed = titled.where("_key is not null").groupBy("_on", "_key").agg(F.collect_list("_title").alias("_titles"))
    placed = keyed.select("_on", "_key", "_titles", F.explode("_titles").alias("_title"))
    placed = placed.unionByName(titled.where("_key is null").withColumn("_titles", F.array().cast("array<string>")))
    times = F.when(F.col("_gram").isNull(), 1).otherwise(F.size(F.filter("_titles", lambda other: F.contains(other, F.col("_gram")))))
    met = placed.join(found, ["_on", "_title"]).select(*probes.columns, "_key", F.explode(F.array_repeat(F.lit(1), times)))
    return met.select(*probes.columns, F.col("_key").alias(key))


def outer_chain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """``FULL OUTER JOIN … USING`` over all frames.  Null keys match nothing."""
    first, *others = frames
    for other in others:
        first = first.join(other, list(keys), "full")
    return first


def attach_parent(child: DataFrame, parent: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Parent columns on each child; children without a parent are left out."""
    return child.join(parent.select(on, *columns), on, "inner")


def expand_by_ids(df: DataFrame, window: Column, id_column: str) -> DataFrame:
    """All rows of every id that has a row inside the window."""
    ids = df.where(window & F.col(id_column).isNotNull()).select(id_column).distinct()
    return df.join(ids, id_column, "left_semi")
