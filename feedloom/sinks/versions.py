"""Tables that change by publishing a version, and rewrite only the files a batch concerns.

A table is a folder: ``data`` holds Parquet files that are never changed, ``_manifests`` lists of files, and
``_versions`` one small file per version, which names its list.  The newest of those is the table.  A load writes
new files, then the new list, and last renames the version's file into place, which fails if a version of that
number is there already.  That rename is all a reader can see: a load that dies before it leaves the table as it
was, and one that dies after it is done, so a load can be stopped anywhere and repeated.  What a dead load has
left behind is named by no list; ``vacuum`` removes it.  A table has one writer at a time, a second one gets
``Conflict``.

A list has a row per file with the buckets its rows fall into: hashes of the key, or days.  The buckets of a
batch are joined to them, and the key column of the few files left tells which hold a key of the batch.  Only
those are read and written anew; all others stay under their names.  Rows are gathered by bucket as they are
written, so a key stands in few files, and a bucket that holds too much is split among several.

Without a table a load makes it.  Null keys are never found.  Batches are computed once: they are written before
they are compared.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.sinks.merge import merge_upsert, outside_window

DATA, MANIFESTS, VERSIONS, STAGED = "data", "_manifests", "_versions", "_staged"
BUCKETS = 1 << 15
FEW_KEYS = 8 << 20  # bytes of the files of staged rows that are broadcast
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
OPEN_COST, WHOLE_FILES = "spark.sql.files.openCostInBytes", str(1 << 40)  # so that no task reads two files
MANIFEST = "file string, rows bigint, buckets array<int>"
FILE_PATH = "_metadata.file_path"


class Conflict(RuntimeError):
    """Another load has published this version meanwhile."""


@dataclass(frozen=True)
class ByKey:
    """Files are looked up by hashes of a key."""

    key: str

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class ByDay:
    """Files are looked up by the day of a moment; -2147483648 stands for none."""

    moment: str

    def bucket(self) -> Column:
        return F.coalesce(F.unix_date(F.to_date(F.col(self.moment).try_cast("timestamp"))), F.lit(-(2**31)))


Index = ByKey | ByDay


@dataclass(frozen=True)
class Version:
    number: int
    manifest: str
    schema: T.StructType
    note: dict = field(default_factory=dict)  # what a load says about itself


def _files(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def _listed(spark: SparkSession, path: str) -> list:
    files, location = _files(spark, path)
    return list(files.listStatus(location)) if files.exists(location) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the published versions, oldest first."""
    names = [status.getPath().getName() for status in _listed(spark, f"{path}/{VERSIONS}")]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A published version, by default the newest; none where there is no table."""
    numbers = versions(spark, path)
    if number is None and not numbers:
        return None
    number = numbers[-1] if number is None else number
    said = json.loads(spark.read.text(f"{path}/{VERSIONS}/{number:020d}.json", wholetext=True).first()[0])
    return Version(number, said["manifest"], T.StructType.fromJson(said["schema"]), said.get("note", {}))


def manifest(spark: SparkSession, path: str, at: Version) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/{at.manifest}")


def _rows(spark: SparkSession, path: str, schema: T.StructType, files: Sequence[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{file}" for file in files])


def _file(location: str) -> Column:
    """A file's name in the list, from where it lies."""
    return F.regexp_extract(location, f"({DATA}/[^/]+/[^/]+)$", 1)


def _named(files: DataFrame) -> list[str]:
    # The names of files only, which the reader needs on the driver in any case.
    return sorted(row["file"] for row in files.select("file").collect())


def read_table(spark: SparkSession, path: str, number: int | None = None, like: DataFrame | None = None) -> DataFrame:
    """The table as of a version; before its first load no rows of the columns of ``like``."""
    at = version(spark, path, number)
    if at is None:
        if like is None:
            raise FileNotFoundError(path)
        return like.where(F.lit(False))
    return _rows(spark, path, at.schema, _named(manifest(spark, path, at)))


# The steps that change something, in the order a load takes them.


def write_rows(rows: DataFrame, path: str, by: Index, max_rows: int = 0, gathered: bool = False) -> str:
    """New files of rows gathered by bucket; returns their folder in the table.

    Rows that are ``gathered`` already, read from files staged by bucket, are written file by file, with no shuffle.
    """
    folder = f"{DATA}/{uuid4().hex}"
    if not gathered:
        _written(_gathered(rows, by), f"{path}/{folder}", max_rows)
        return folder
    conf = rows.sparkSession.conf
    before = conf.get(OPEN_COST)
    conf.set(OPEN_COST, WHOLE_FILES)
    try:
        _written(rows, f"{path}/{folder}", max_rows)
    finally:
        conf.set(OPEN_COST, before)
    return folder


def _gathered(rows: DataFrame, by: Index) -> DataFrame:
    return rows.withColumn("_bucket", by.bucket()).hint("rebalance", "_bucket").sortWithinPartitions("_bucket").drop("_bucket")


def _written(rows: DataFrame, folder: str, max_rows: int = 0) -> None:
    writer = rows.write.option("compression", "zstd")
    (writer.option("maxRecordsPerFile", max_rows) if max_rows else writer).parquet(folder)


def write_rest(spark: SparkSession, path: str, at: Version, files: Sequence[str], keys: DataFrame, by: ByKey, max_rows: int = 0) -> str:
    """New files of what some files hold beside staged keys; returns their folder in the table.

    The files are gathered by bucket already.  Few keys are broadcast, and what is left is written as it is read, with
    no shuffle.  Otherwise rows and keys meet by bucket, one shuffle that serves both the join and the new files.
    """
    folder = f"{DATA}/{uuid4().hex}"
    rows = _rows(spark, path, at.schema, files)
    if is_small(keys):
        _written(rows.join(F.broadcast(keys), by.key, "left_anti").select(*at.schema.names), f"{path}/{folder}", max_rows)
        return folder
    rows, keys = (frame.withColumn("_bucket", by.bucket()).repartition("_bucket") for frame in (rows, keys))
    rest = rows.join(keys, ["_bucket", by.key], "left_anti").sortWithinPartitions("_bucket")
    before = spark.conf.get(ALL_KEYS)
    spark.conf.set(ALL_KEYS, "false")  # rows of one bucket are together, so those of one key are
    try:
        _written(rest.select(*at.schema.names), f"{path}/{folder}", max_rows)
    finally:
        spark.conf.set(ALL_KEYS, before)
    return folder


def is_small(staged: DataFrame) -> bool:
    """Whether staged rows are few enough to be broadcast."""
    return _bytes(staged) <= FEW_KEYS


def _bytes(staged: DataFrame) -> int:
    spark = staged.sparkSession
    return sum(_files(spark, file)[0].getFileStatus(_files(spark, file)[1]).getLen() for file in staged.inputFiles())


def stage(batch: DataFrame, path: str, by: Index | None = None) -> DataFrame:
    """The batch, computed once and read from beside the table; its rows are gathered by bucket if ``by`` is given."""
    folder = f"{path}/{STAGED}/{uuid4().hex}"
    _written(_gathered(batch, by) if by else batch, folder)
    return batch.sparkSession.read.schema(batch.schema).parquet(folder)


def write_manifest(spark: SparkSession, path: str, kept: DataFrame | None, folders: Sequence[str], schema: T.StructType, by: Index) -> str:
    """The list of the files kept and of the rows of new folders."""
    folder = f"{MANIFESTS}/{uuid4().hex}"
    parts = [] if kept is None else [kept.select("file", "rows", "buckets")]
    if folders:
        found = spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders])
        # Rows are counted per bucket of a file first; sets of buckets and names are made of what is left.
        placed = found.select(F.col(FILE_PATH).alias("_path"), by.bucket().alias("bucket")).groupBy("_path", "bucket")
        counted = placed.agg(F.count(F.lit(1)).alias("rows")).groupBy(_file("_path").alias("file"))
        parts.append(counted.agg(F.sum("rows").alias("rows"), F.collect_set("bucket").alias("buckets")))
    listed = parts[0].union(parts[1]) if len(parts) == 2 else parts[0] if parts else spark.createDataFrame([], MANIFEST)
    listed.coalesce(1).write.parquet(f"{path}/{folder}")
    return folder


def write_marker(spark: SparkSession, path: str, at: Version) -> str:
    """What the version's file will hold, under another name."""
    name = f"{path}/{VERSIONS}/_{uuid4().hex}"
    files, location = _files(spark, name)
    out = files.create(location, False)
    out.write(bytearray(json.dumps({"manifest": at.manifest, "schema": at.schema.jsonValue(), "note": at.note}).encode()))
    out.close()
    return name


def publish_marker(spark: SparkSession, path: str, name: str, number: int) -> None:
    """Make the version the table's newest, unless there is one of this number."""
    fs = spark._jvm.org.apache.hadoop.fs
    source, target = fs.Path(name), fs.Path(f"{path}/{VERSIONS}/{number:020d}.json")
    files, _ = _files(spark, name)
    context = fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    none = spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(source), files.makeQualified(target), none)
    except Py4JJavaError as failure:
        if "FileAlreadyExists" in str(failure.java_exception):
            raise Conflict(f"version {number} of {path} is there already") from failure
        raise


def remove_path(spark: SparkSession, path: str) -> None:
    files, location = _files(spark, path)
    files.delete(location, True)


def _publish(spark: SparkSession, path: str, base: Version | None, kept: DataFrame | None, folders: Sequence[str], schema: T.StructType, by: Index, note: dict | None = None) -> DataFrame:
    number = base.number + 1 if base else 1
    made = Version(number, write_manifest(spark, path, kept, folders, schema, by), schema, note or {})
    publish_marker(spark, path, write_marker(spark, path, made), number)
    return read_table(spark, path)


def _plain(schema: T.StructType) -> T.StructType:
    """Columns as files have them: all may be null."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


# Loads.


def load_full(batch: DataFrame, path: str, by: Index, max_rows: int = 0) -> DataFrame:
    """The batch replaces the table."""
    spark = batch.sparkSession
    base = version(spark, path)
    return _publish(spark, path, base, None, [write_rows(batch, path, by, max_rows)], _plain(batch.schema), by)


def sharing(spark: SparkSession, path: str, at: Version, rows: DataFrame, by: Index) -> list[str]:
    """The files that have a bucket in common with the rows: for days, those that hold one of their days."""
    wanted = rows.select(by.bucket().alias("bucket")).distinct()
    by_bucket = manifest(spark, path, at).select("file", F.explode("buckets").alias("bucket"))
    return _named(by_bucket.join(wanted, "bucket", "left_semi").select("file").distinct())


def holding(spark: SparkSession, path: str, at: Version, keys: DataFrame, key: str) -> list[str]:
    """The files that hold one of the keys."""
    near = sharing(spark, path, at, keys, ByKey(key))
    if not near:
        return []
    held = _rows(spark, path, at.schema, near).select(F.col(key), F.col(FILE_PATH).alias("_path"))
    found = held.join(keys.select(key).distinct(), key, "left_semi").select("_path").distinct()
    return _named(found.select(_file("_path").alias("file")))


def _without(spark: SparkSession, path: str, at: Version, files: Sequence[str]) -> DataFrame:
    return manifest(spark, path, at).where(~F.col("file").isin(list(files))) if files else manifest(spark, path, at)


def _aligned(batch: DataFrame, at: Version | None) -> DataFrame:
    """The batch in the table's columns and types."""
    if at is None:
        return batch
    return batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in at.schema])


def _load(batch: DataFrame, path: str, key: str, max_rows: int, first: Callable, build: Callable) -> DataFrame:
    """A load by key: ``build`` makes the rows that take the place of the files that hold the batch's keys."""
    spark, by = batch.sparkSession, ByKey(key)
    base = version(spark, path)
    staged = stage(_aligned(batch, base), path)
    if base is None:
        return _publish(spark, path, None, None, [write_rows(first(staged), path, by, max_rows)], _plain(staged.schema), by)
    files = holding(spark, path, base, staged, key)
    made = build(_rows(spark, path, base.schema, files), staged)
    return _publish(spark, path, base, _without(spark, path, base, files), [write_rows(made, path, by, max_rows)], base.schema, by)


def load_by_key(batch: DataFrame, path: str, key: str, max_rows: int = 0, gathered: bool = False) -> DataFrame:
    """Rows whose key is in the batch give way to the batch.

    The batch's own files become the table's; only other rows of touched files are written once more.  ``gathered`` says
    that the batch is read, without a shuffle, from files whose rows are gathered by the same key.
    """
    spark, by = batch.sparkSession, ByKey(key)
    base = version(spark, path)
    fresh = write_rows(_aligned(batch, base), path, by, max_rows, gathered)
    if base is None:
        return _publish(spark, path, None, None, [fresh], _plain(batch.schema), by)
    keys = stage(spark.read.schema(base.schema).parquet(f"{path}/{fresh}").select(key).distinct(), path)
    files = holding(spark, path, base, keys, key)
    folders = [fresh]
    if files:
        folders.append(write_rest(spark, path, base, files, keys, by, max_rows))
    return _publish(spark, path, base, _without(spark, path, base, files), folders, base.schema, by)


def load_where(batch: DataFrame, path: str, key: str, keep: Column, max_rows: int = 0) -> DataFrame:
    """As ``load_by_key``, but only batch rows that pass ``keep`` are put back."""

    def build(rows, staged):
        left = rows.join(staged.select(key).distinct(), key, "left_anti").select(*rows.columns)
        return left.unionByName(staged.where(keep))

    return _load(batch, path, key, max_rows, lambda staged: staged.where(keep), build)


def load_upsert(batch: DataFrame, path: str, key: str, compare: Sequence[str], null_safe: bool = False, max_rows: int = 0) -> DataFrame:
    """``merge_upsert`` of a batch with one row per key; files without one of its keys are not read beyond the list."""
    return _load(batch, path, key, max_rows, lambda staged: staged, lambda rows, staged: merge_upsert(rows, staged, key, compare, null_safe))


def load_new(batch: DataFrame, path: str, key: str, max_rows: int = 0) -> DataFrame:
    """Append the batch rows whose key the table lacks; no file is written again."""
    spark, by = batch.sparkSession, ByKey(key)
    base = version(spark, path)
    staged = stage(_aligned(batch, base), path)
    if base is None:
        return _publish(spark, path, None, None, [write_rows(staged, path, by, max_rows)], _plain(staged.schema), by)
    held = _rows(spark, path, base.schema, holding(spark, path, base, staged, key)).select(key).distinct()
    fresh = write_rows(staged.join(held, key, "left_anti").select(*staged.columns), path, by, max_rows)
    return _publish(spark, path, base, manifest(spark, path, base), [fresh], base.schema, by)


def load_days(batch: DataFrame, path: str, moment: str, start: str, end: str | None, drop_null: bool = False, max_rows: int = 0, gathered: bool = False) -> DataFrame:
    """``replace_by_window``: rows from ``start`` to the end of day ``end``, or all later ones, give way to the batch.

    ``gathered`` says that the batch is read from where it has been staged by its days.
    """
    spark, by = batch.sparkSession, ByDay(moment)
    base = version(spark, path)
    fresh = write_rows(_aligned(batch, base), path, by, max_rows, gathered)
    if base is None:
        return _publish(spark, path, None, None, [fresh], _plain(batch.schema), by)
    first = F.unix_date(F.to_date(F.lit(start)))
    last = F.lit(2**31 - 1) if end is None else F.unix_date(F.to_date(F.lit(end)))
    none = F.lit(-(2**31))
    touched = F.exists("buckets", lambda day: ((day >= first) & (day <= last) & (day != none)) | (F.lit(drop_null) & (day == none)))
    files = _named(manifest(spark, path, base).where(touched))
    folders = [fresh]
    if files:
        outside = outside_window(F.col(moment).try_cast("timestamp"), start, end, drop_null)
        rest = f"{DATA}/{uuid4().hex}"  # gathered by day in their files, so written as they are read
        _written(_rows(spark, path, base.schema, files).where(outside), f"{path}/{rest}", max_rows)
        folders.append(rest)
    return _publish(spark, path, base, _without(spark, path, base, files), folders, base.schema, by)


def rows_of(spark: SparkSession, path: str, at: Version, files: Sequence[str]) -> DataFrame:
    """What some files of the table hold."""
    return _rows(spark, path, at.schema, files)


def load_more(batch: DataFrame, path: str, by: Index) -> DataFrame:
    """Append the batch."""
    spark = batch.sparkSession
    base = version(spark, path)
    fresh = write_rows(_aligned(batch, base), path, by)
    return _publish(spark, path, base, manifest(spark, path, base) if base else None, [fresh], base.schema if base else _plain(batch.schema), by)


def exchange(rows: DataFrame, path: str, files: Sequence[str], by: Index, note: dict | None = None) -> DataFrame:
    """The rows take the place of some of the table's files; ``note`` is published with them."""
    spark = rows.sparkSession
    base = version(spark, path)
    kept = _without(spark, path, base, files) if base else None
    return _publish(spark, path, base, kept, [write_rows(rows, path, by)], base.schema if base else _plain(rows.schema), by, note)


def compact(spark: SparkSession, path: str, by: Index, small: int) -> DataFrame:
    """Files of fewer than ``small`` rows are written together; the table's rows stay as they are."""
    base = version(spark, path)
    files = _named(manifest(spark, path, base).where(F.col("rows") < small))
    if len(files) < 2:
        return read_table(spark, path)
    folder = write_rows(_rows(spark, path, base.schema, files), path, by)
    return _publish(spark, path, base, _without(spark, path, base, files), [folder], base.schema, by, base.note)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove what none of the last ``keep`` versions names; not while a load is running."""
    numbers = versions(spark, path)
    held = [version(spark, path, n) for n in numbers[-keep:]]
    named = {file for at in held for file in _named(manifest(spark, path, at))}
    lists = {at.manifest for at in held}
    for number in numbers[:-keep]:
        remove_path(spark, f"{path}/{VERSIONS}/{number:020d}.json")
    for status in _listed(spark, f"{path}/{VERSIONS}"):
        if status.getPath().getName().startswith("_"):
            remove_path(spark, status.getPath().toString())
    for status in _listed(spark, f"{path}/{MANIFESTS}"):
        if f"{MANIFESTS}/{status.getPath().getName()}" not in lists:
            remove_path(spark, status.getPath().toString())
    remove_path(spark, f"{path}/{STAGED}")
    for folder in _listed(spark, f"{path}/{DATA}"):
        name = folder.getPath().getName()
        here = [f.getPath().getName() for f in _listed(spark, folder.getPath().toString())]
        gone = [f for f in here if f"{DATA}/{name}/{f}" not in named]
        if len(gone) == len(here) or all(f.startswith(("_", ".")) for f in set(here) - set(gone)):
            remove_path(spark, folder.getPath().toString())
            continue
        for file in gone:
            if not file.startswith(("_", ".")):
                remove_path(spark, f"{folder.getPath().toString()}/{file}")
