"""Files and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


# Cell texts the feeds' reader takes for missing.
MISSING_CELLS = (
    " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    sep: str = ";",
    missing: Sequence[str] = MISSING_CELLS,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited file with a header, every column as text; types are applied later.

    Without ``columns`` Spark reads the header line of the first file.  Nothing is
    inferred from the data, so no pass over it is spent on that.  Line breaks inside
    quotes need ``multi_line``, at the price of one task per file.
    """
    # The escape character is the quote itself: a doubled quote stands for one.
    reader = spark.read.option("header", True).option("sep", sep).option("escape", '"')
    reader = reader.option("multiLine", multi_line).option("enforceSchema", columns is None)
    if columns is not None:
        reader = reader.schema(text_schema(columns))
    df = reader.csv(path)
    if not missing:
        return df
    cells = {name: F.col("`" + name.replace("`", "``") + "`") for name in df.columns}
    return df.select([F.when(~cell.isin(*missing), cell).alias(name) for name, cell in cells.items()])


def read_table(spark: SparkSession, ref: str, jdbc: dict[str, str] | None = None, parts: Sequence[str] = ()) -> DataFrame:
    """A whole table: a Parquet path, a catalog name, or a remote table by JDBC.

    For a large remote table pass ``parts``, predicates that cut it (``plan_parts``), each of which
    one task reads; without them, or ``partitionColumn`` and its bounds among the options, one task reads all.
    """
    if jdbc is not None and parts:
        options = {k: v for k, v in jdbc.items() if k != "url"}
        return spark.read.jdbc(jdbc["url"], ref, predicates=list(parts), properties=options)
    if jdbc is not None:
        return spark.read.format("jdbc").options(dbtable=ref, **jdbc).load()
    return spark.read.parquet(ref) if "/" in ref else spark.read.table(ref)


def read_day(df: DataFrame, column: str, day: str) -> DataFrame:
    """One day of a table.

    On a date column that partitions the table this prunes directories; on a timestamp
    it is a half-open range on the bare column, which the Parquet reader can use.
    """
    if isinstance(df.schema[column].dataType, T.TimestampType | T.TimestampNTZType):
        start = F.to_timestamp(F.lit(day))
        after = F.to_timestamp(F.date_add(F.to_date(F.lit(day)), 1))
        return df.where((F.col(column) >= start) & (F.col(column) < after))
    return df.where(F.col(column) == F.to_date(F.lit(day)))
