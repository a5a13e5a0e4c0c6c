"""Base table of web events: one flat row per event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions import map_channel, parse_dt, payment_type
from feedloom.functions.dates import SHARD_FORMAT
from feedloom.operators.filters import exclude_values
from feedloom.operators.headers import canonical_headers
from feedloom.operators.nested import only_item, pivot_params
from feedloom.operators.shape import truncate_all
from feedloom.specs import web


def event_base(events: DataFrame, on_many: str = "error") -> DataFrame:
    """Flatten the export; ``on_many`` says what an event with several items does."""
    wanted = {name: (name, "string_value") for name in [*web.TEXT_PARAMS, *web.PAYMENT_PARAMS]}
    wanted |= {name: (name, "int_value") for name in web.NUMBER_PARAMS}
    kept = exclude_values(events, "event_name", web.LEFT_OUT)
    flat = pivot_params(kept, "event_params", wanted).select(
        "event_date",
        F.date_format(parse_dt("event_date", SHARD_FORMAT), "yyyy-MM-dd").alias("event_br_timestamp"),
        "event_name", "user_id", "user_pseudo_id",
        *web.TEXT_PARAMS,
        payment_type(*web.PAYMENT_PARAMS).alias("payment_type"),
        *web.NUMBER_PARAMS,
        *[F.col(path).alias(name) for name, path in web.PATHS.items()],
        *[only_item(F.col("items"), field, on_many).alias(name) for name, field in web.ITEM_FIELDS.items()],
        map_channel(web.MEDIUM_PATH).alias("cross_channel_medium"),
    )
    return canonical_headers(truncate_all(flat, web.TEXT_LENGTH), "upper")
