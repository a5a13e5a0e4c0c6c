"""Landed API pages: opening the envelopes and checking that no page is missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import strip

# Members that hold the record list, in order of preference; "result" holds
# the second one, as an object or as JSON text.
LIST_MEMBERS = ("tickets", "rows", "orders", "users", "events", "data")
RESULT, ERROR = "result", "error"
RESULT_LIST = "rows"
# What an error member looks like when there is no error.
NO_ERROR = ("", "false", "0", "[]", "{}")

CHUNK = 10_000


class PagesMissing(RuntimeError):
    """A feed landed fewer pages than it announced."""


def unwrap_pages(
    df: DataFrame,
    body: str,
    row_schema: T.StructType,
    keep: Sequence[str] = (),
    members: Sequence[str] = LIST_MEMBERS,
    strict: bool = True,
) -> DataFrame:
    """One row per record of every page, typed by ``row_schema``.

    A page is a bare list, a list of one object, or an object with the list under one of
    ``members`` or under ``result``.  An empty list gives no rows.  A page that reports an
    error stops the job, and so does one without any list unless ``strict`` is off.

    An object is parsed once, into all the members it might have; text in the place of a
    parsed value is what Spark gives for a member declared as a string.
    """
    listed = T.ArrayType(row_schema)
    page = T.StructType([
        T.StructField(ERROR, T.StringType()), T.StructField(RESULT, T.StringType()),
        *[T.StructField(name, listed) for name in members],
    ])
    inner = T.StructType([T.StructField(RESULT_LIST, listed)])
    is_list = F.startswith(strip(body), F.lit("["))
    wrapped = F.get_json_object(body, f"$[0].{members[0]}")
    opened = df.select(
        *keep,
        F.when(~is_list, F.from_json(body, page)).alias("_page"),
        F.when(is_list, F.coalesce(F.from_json(wrapped, listed), F.from_json(body, listed))).alias("_bare"),
    )
    opened = opened.withColumn("_result", F.from_json(f"_page.{RESULT}", inner)[RESULT_LIST])
    lists = ["_bare", f"_page.{members[0]}", "_result", *[f"_page.{name}" for name in members[1:]]]
    # The first list with records, else any list at all.
    filled = [F.when(F.size(name) > 0, F.col(name)) for name in lists]
    failure = F.when(
        ~F.col(f"_page.{ERROR}").isin(*NO_ERROR),
        F.raise_error(F.concat(F.lit("page reports error: "), F.col(f"_page.{ERROR}"))).cast(listed),
    )
    nothing = F.raise_error(F.lit("page holds no record list")).cast(listed)
    otherwise = [F.col(name) for name in lists] + ([nothing] if strict else [])
    records = F.coalesce(failure, *filled, *otherwise)
    return opened.select(*keep, F.explode(records).alias("_row")).select(*keep, "_row.*")


def missing_pages(df: DataFrame, feed: str, page: str, pages: str | None = None) -> DataFrame:
    """Page numbers from 1 to the announced count (or the highest seen) that did not land.

    Feeds that are complete are settled by counting.  Only for the others are landed
    pages compared and numbers written out, in chunks, so that one long feed is spread
    over many tasks.
    """
    expected = F.max(pages or page).cast("bigint")
    in_range = F.when(F.col(page) >= 1, F.col(page))
    state = df.groupBy(feed).agg(
        expected.alias("_expected"), F.count_distinct(in_range).alias("_seen")
    )
    short = state.where(F.col("_seen") < F.col("_expected"))
    chunks = short.select(
        feed, "_expected",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("_expected") - 1) / CHUNK))).alias("_chunk"),
    ).repartition(feed, "_chunk")
    first = F.col("_chunk") * CHUNK + 1
    last = F.least(F.col("_expected"), F.col("_chunk") * CHUNK + CHUNK)
    numbers = chunks.select(feed, F.explode(F.sequence(first, last)).alias(page))
    landed = df.select(feed, F.col(page).cast("bigint").alias(page)).join(short, feed, "left_semi").distinct()
    return numbers.join(landed, [feed, page], "left_anti")


def check_pages(
    df: DataFrame, feed: str, page: str, pages: str | None = None, on_missing: str = "fail"
) -> DataFrame:
    """The pages, if none is missing.  ``on_missing="skip"`` goes on without the missing ones."""
    if on_missing == "fail":
        gaps = missing_pages(df, feed, page, pages).limit(5).collect()
        if gaps:
            raise PagesMissing(f"pages missing, for example {[tuple(gap) for gap in gaps]}")
    return df
