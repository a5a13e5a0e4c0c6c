"""Daily campaign report: views, sessions, active users, cart adds, purchasers, revenue."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import parse_dt
from feedloom.functions.dates import SHARD_FORMAT
from feedloom.operators.groups import distinct_if, distinct_sessions, sum_or_zero, two_level
from feedloom.operators.nested import param
from feedloom.operators.presence import count_presence, number_members, presence
from feedloom.sinks import versions
from feedloom.specs import web

MEASURES = ["views", "sessions", "active_users", "add_to_cart", "total_purchasers", "revenue"]


@dataclass(frozen=True)
class CrmColumns:
    """Names of the flat event columns the report reads."""

    day: str = "event_date"
    campaign: str = "campaign_name_cross"
    city: str = "city"
    user: str = "user_pseudo_id"
    session: str = "ga_session_id"
    event: str = "event_name"
    active: str = "is_active_user"
    revenue: str = "purchase_revenue"

    @property
    def keys(self) -> list[str]:
        return [self.day, self.campaign, self.city]


def crm_shape(events: DataFrame) -> DataFrame:
    """The report's flat columns from the nested export."""
    campaign = "session_traffic_source_last_click.cross_channel_campaign.campaign_name"
    return events.select(
        "event_date", F.col(campaign).alias("campaign_name_cross"), F.col("geo.city").alias("city"),
        "user_pseudo_id", param(F.col("event_params"), "ga_session_id", "int_value").alias("ga_session_id"),
        "event_name", "is_active_user", F.col("ecommerce.purchase_revenue").alias("purchase_revenue"),
    )


def _is(column: str, value: str) -> Column:
    return F.col(column) == value


def crm_parts(events: DataFrame, c: CrmColumns = CrmColumns()) -> dict[str, DataFrame]:
    """The report's four parts, each per (day, campaign, city)."""
    per_user = [*c.keys, c.user]
    return {
        "views": two_level(
            events, per_user, c.keys,
            {"n": F.count_if(_is(c.event, web.PAGE_VIEW))}, {"views": F.sum("n")},
        ),
        "sessions": distinct_sessions(events, c.keys, [c.user, c.session]),
        "active_users": distinct_if(events, c.keys, c.user, F.col(c.active), "active_users"),
        "purchases": two_level(
            events, per_user, c.keys,
            {
                "carts": F.count_if(_is(c.event, web.ADD_TO_CART)),
                "buyer": F.max(F.when(_is(c.event, web.PURCHASE), F.col(c.user))),
                "paid": F.sum(c.revenue),
            },
            {
                "add_to_cart": F.sum("carts"),
                "total_purchasers": F.count_distinct("buyer"),
                "revenue": sum_or_zero(F.col("paid")),
            },
        ),
    }


def crm_daily_fused(events: DataFrame, c: CrmColumns = CrmColumns()) -> DataFrame:
    """One row per (day, campaign, city), nulls being keys like any other.

    The events are read once.  They are reduced per user and session, then per user,
    then per group; a user or a campaign with a large share of all events is reduced
    before each shuffle.
    """
    known = F.col(c.user).isNotNull()
    per_user = events.groupBy(*c.keys, c.user).agg(
        F.count_if(_is(c.event, web.PAGE_VIEW)).alias("views"),
        F.count_distinct(F.when(known, F.col(c.session))).alias("sessions"),
        F.max(known & F.col(c.active)).alias("active"),
        F.count_if(_is(c.event, web.ADD_TO_CART)).alias("carts"),
        F.max(known & _is(c.event, web.PURCHASE)).alias("buyer"),
        F.sum(c.revenue).alias("paid"),
    )
    return per_user.groupBy(*c.keys).agg(
        F.sum("views").alias("views"),
        F.sum("sessions").alias("sessions"),
        F.count_if("active").alias("active_users"),
        F.sum("carts").alias("add_to_cart"),
        F.count_if("buyer").alias("total_purchasers"),
        sum_or_zero(F.col("paid")).alias("revenue"),
    )


def _part(*filled: str) -> Column:
    return F.struct(*[
        (F.col(m) if m in filled else F.lit(0).cast("double" if m == "revenue" else "bigint")).alias(m)
        for m in MEASURES
    ])


def load_crm_day(folder: str, events: DataFrame, c: CrmColumns = CrmColumns()) -> None:
    """Add days to a report that is kept: sums per group, and bitmaps of its sessions, active users and buyers.

    Only the given days' events are read.  Days that are there already are replaced, so a day can be loaded again.
    """
    spark = events.sparkSession
    known = F.col(c.user).isNotNull()
    session = F.concat(F.col(c.user).cast("string"), F.lit("-"), F.col(c.session).cast("string"))
    whom = {
        "sessions": session,
        "active_users": F.when(F.col(c.active), F.concat(F.lit("u"), F.col(c.user).cast("string"))),
        "total_purchasers": F.when(_is(c.event, web.PURCHASE), F.concat(F.lit("u"), F.col(c.user).cast("string"))),
    }
    day = F.coalesce(F.col(c.day).cast("string"), F.lit(""))  # as a key: events without a day are replaced too
    rows = events.select(
        *c.keys, day.alias("_day"), F.posexplode_outer(F.when(known, F.array(*whom.values()))).alias("_measure", "_member")
    )
    members = rows.select("_member").where("_member is not null").distinct()
    numbers = f"{folder}/members"
    at = versions.version(spark, numbers)
    fresh = number_members(members, "_member", None if at is None else versions.read_table(spark, numbers))
    named = versions.load_new(fresh, numbers, "_member")
    found = presence(rows.join(named, "_member"), [*c.keys, "_day", "_measure"], "number")
    sums = events.groupBy(*c.keys, day.alias("_day")).agg(
        F.count_if(_is(c.event, web.PAGE_VIEW)).alias("views"), F.count_if(_is(c.event, web.ADD_TO_CART)).alias("add_to_cart"),
        sum_or_zero(F.col(c.revenue)).alias("revenue"),
    )
    versions.load_by_key(found, f"{folder}/presence", "_day")
    versions.load_by_key(sums, f"{folder}/sums", "_day")


def read_crm(spark: SparkSession, folder: str, by: Sequence[str] | None = None, c: CrmColumns = CrmColumns()) -> DataFrame:
    """The kept report, by the columns of ``crm_daily_fused`` or by fewer: each person counts once in a group, over all its days."""
    by = list(c.keys if by is None else by)
    report = versions.read_table(spark, f"{folder}/sums").groupBy(*by).agg(*[F.sum(m).alias(m) for m in ("views", "add_to_cart", "revenue")])
    counts = count_presence(versions.read_table(spark, f"{folder}/presence"), [*by, "_measure"], "n")
    wide = counts.groupBy(*by).pivot("_measure", [0, 1, 2]).agg(F.sum("n"))
    same = F.lit(True)
    for i, name in enumerate(by):
        wide = wide.withColumnRenamed(name, f"_by_{i}")
        same = same & F.col(name).eqNullSafe(F.col(f"_by_{i}"))
    joined = report.join(wide, same, "left")
    held = {"sessions": "0", "active_users": "1", "total_purchasers": "2"}
    return joined.select(*by, *[F.coalesce(held[m], F.lit(0)).cast("bigint").alias(m) if m in held else F.col(m) for m in MEASURES])


def crm_daily(events: DataFrame, c: CrmColumns = CrmColumns()) -> DataFrame:
    """The report as its consumers know it.

    It is defined as four grouped parts put together by full outer joins, in which a
    null campaign or city meets nothing: such a group shows as four rows, one per part.
    All parts have the same groups, so the joins need not run: the groups of a single
    pass are the joined rows, and those with a null key are split up.
    """
    groups = crm_daily_fused(events, c)
    null_key = F.greatest(*[F.col(k).isNull() for k in c.keys])
    rows = F.when(
        null_key,
        F.array(_part("views"), _part("sessions"), _part("active_users"),
                _part("add_to_cart", "total_purchasers", "revenue")),
    ).otherwise(F.array(_part(*MEASURES)))
    day = F.date_format(parse_dt(F.col(c.day), SHARD_FORMAT), "yyyy-MM-dd")
    return (
        groups.select(*c.keys, F.inline(rows))
        .orderBy(*c.keys)
        .select(
            day.alias("EVENT_BR_TIMESTAMP"), F.col(c.campaign).alias("CAMPAIGN_NAME_CROSS"),
            F.col(c.city).alias("CITY"), *MEASURES,
        )
    )
