"""Loads that are stopped anywhere, and files that a batch does not concern."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedloom import plans, sinks
from feedloom.sinks import tables, versions
from tests.conftest import rows

STEPS = ("stage", "write_rows", "write_manifest", "write_marker", "publish_marker")


class Stopped(Exception):
    pass


def stop_at(monkeypatch, module, names, at):
    """The ``at``-th file operation dies before it starts (even) or right after it is done (odd)."""
    count = {"n": 0}

    def dying(operation):
        def run(*args, **kwargs):
            number = count["n"]
            count["n"] += 1
            if number == at // 2 and at % 2 == 0:
                raise Stopped
            found = operation(*args, **kwargs)
            if number == at // 2:
                raise Stopped
            return found
        return run

    for name in names:
        monkeypatch.setattr(module, name, dying(getattr(module, name)))


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(i, f"name{i}", f"2024-01-{1 + i % 9:02d} 10:00:00") for i in range(40)], "id int, nome string, at string")


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([(i, "new", "2024-01-03 11:00:00") for i in (3, 4, 100)], "id int, nome string, at string")


LOADS = {
    "full": (lambda b, p: versions.load_full(b, p, versions.ByKey("id"), 4), lambda t, b: b),
    "by_key": (lambda b, p: versions.load_by_key(b, p, "id", 4), lambda t, b: sinks.replace_by_key(t, b, "id")),
    "where": (lambda b, p: versions.load_where(b, p, "id", F.col("id") > 3, 4), lambda t, b: sinks.replace_where(t, b, "id", F.col("id") > 3)),
    "upsert": (lambda b, p: versions.load_upsert(b, p, "id", ["nome"], max_rows=4), lambda t, b: sinks.merge_upsert(t, b, "id", ["nome"])),
    "new": (lambda b, p: versions.load_new(b, p, "id", 4), lambda t, b: sinks.insert_new(t, b, "id")),
    "days": (lambda b, p: versions.load_days(b, p, "at", "2024-01-03", "2024-01-04", max_rows=4), lambda t, b: sinks.replace_by_window(t, b, "at", "2024-01-03", "2024-01-04")),
}


def first(people, path, name):
    return versions.load_full(people, path, versions.ByDay("at") if name == "days" else versions.ByKey("id"), 4)


@pytest.mark.parametrize("name", list(LOADS))
def test_a_load_stopped_anywhere_and_repeated(spark, people, batch, tmp_path, name):
    load, expected = LOADS[name]
    before, after = rows(people), rows(expected(people, batch))
    for at in range(20):
        path = str(tmp_path / f"t{at}")
        first(people, path, name)
        with pytest.MonkeyPatch.context() as patched:
            stop_at(patched, versions, STEPS, at)
            try:
                load(batch, path)
                done = True
            except Stopped:
                done = False
        published = len(versions.versions(spark, path)) == 2
        assert rows(versions.read_table(spark, path)) == (after if published else before)
        assert rows(load(batch, path)) == after
        versions.vacuum(spark, path, keep=1)
        assert rows(versions.read_table(spark, path)) == after
        if done:
            break
    assert done and at >= 8  # four operations and more, each stopped before and after


@pytest.mark.parametrize("name", [n for n in LOADS if n != "full"])
def test_files_without_a_key_of_the_batch_stay(spark, people, batch, tmp_path, name):
    path = str(tmp_path / "t")
    load, expected = LOADS[name]
    first(people, path, name)
    held = {r["file"]: r for r in versions.manifest(spark, path, versions.version(spark, path)).collect()}
    assert len(held) >= 8
    # by what the files hold, not by their buckets
    if name == "new":
        touched = set()
    else:
        gone = F.col("at").between("2024-01-03", "2024-01-05") if name == "days" else F.col("id").isin(3, 4)
        touched = {f for f in held if spark.read.parquet(f"{path}/{f}").where(gone).count()}
        assert 0 < len(touched) < len(held) / 2
    assert rows(load(batch, path)) == rows(expected(people, batch))
    now = {r["file"]: r for r in versions.manifest(spark, path, versions.version(spark, path)).collect()}
    assert set(held) - set(now) == touched
    assert sum(r["rows"] for r in now.values()) == versions.read_table(spark, path).count()
    assert rows(versions.read_table(spark, path, 1)) == rows(people)


def test_a_first_load_makes_the_table(spark, batch, tmp_path):
    for name, (load, _) in LOADS.items():
        expected = [r for r in rows(batch) if name != "where" or r[0] > 3]
        assert rows(load(batch, str(tmp_path / name))) == expected
        empty = load(batch.where("false"), str(tmp_path / f"{name}-none"))
        assert empty.count() == 0 and empty.columns == batch.columns
        assert rows(load(batch, str(tmp_path / f"{name}-none"))) == expected


def test_columns_go_by_name_and_take_the_tables_types(spark, people, tmp_path):
    path = str(tmp_path / "t")
    first(people, path, "by_key")
    turned = people.where("id = 1").select("nome", F.col("id").cast("string").alias("id"), "at")
    assert versions.load_by_key(turned, path, "id").schema == versions.read_table(spark, path, 1).schema


def test_null_keys_are_never_found(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(None, "a"), (1, "b")], "id int, nome string")
    versions.load_by_key(frame, path, "id")
    assert rows(versions.load_by_key(frame, path, "id")) == [(None, "a"), (None, "a"), (1, "b")]


def test_a_second_writer_is_refused(spark, people, batch, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first(people, path, "by_key")
    write = versions.write_marker

    def late(*args):
        monkeypatch.setattr(versions, "write_marker", write)
        versions.load_by_key(batch.where("id = 100"), path, "id")
        return write(*args)

    monkeypatch.setattr(versions, "write_marker", late)
    with pytest.raises(versions.Conflict):
        versions.load_by_key(batch, path, "id")
    assert rows(versions.read_table(spark, path)) == rows(sinks.replace_by_key(people, batch.where("id = 100"), "id"))


def test_vacuum_leaves_what_versions_name(spark, people, batch, tmp_path):
    path = tmp_path / "t"
    first(people, str(path), "by_key")
    for _ in range(3):
        versions.load_by_key(batch, str(path), "id", 4)
    before = sum(1 for _ in path.rglob("*.parquet"))
    versions.vacuum(spark, str(path))
    assert versions.versions(spark, str(path)) == [3, 4] and sum(1 for _ in path.rglob("*.parquet")) < before
    for number in (3, 4):
        assert rows(versions.read_table(spark, str(path), number)) == rows(sinks.replace_by_key(people, batch, "id"))


def test_small_files_are_written_together(spark, people, tmp_path):
    path = str(tmp_path / "t")
    by = versions.ByKey("id")
    first(people, path, "by_key")
    for i in range(4):
        versions.load_new(people.where("id = 1").withColumn("id", F.lit(200 + i)), path, "id")
    listed = lambda: versions.manifest(spark, path, versions.version(spark, path)).count()
    held, found = listed(), rows(versions.read_table(spark, path))
    assert rows(versions.compact(spark, path, by, 100)) == found and listed() < held
    at = versions.version(spark, path).number
    assert rows(versions.compact(spark, path, by, 1)) == found and versions.version(spark, path).number == at


def test_a_hot_bucket_stands_in_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    hot = spark.range(5000).select(F.lit(7).alias("id"), F.col("id").alias("x"))
    versions.load_full(hot, path, versions.ByKey("id"), 1000)
    assert versions.manifest(spark, path, versions.version(spark, path)).count() >= 5
    assert versions.load_by_key(hot.limit(1), path, "id").count() == 1


def test_refresh_stopped_anywhere(spark, people, batch, tmp_path):
    """A plain folder: the old table or the new one after the next read, never none."""
    for at in range(10):
        path = str(tmp_path / f"t{at}")
        sinks.full_refresh(people, path)
        with pytest.MonkeyPatch.context() as patched:
            stop_at(patched, tables, ("remove", "move"), at)
            try:
                sinks.full_refresh(batch, path)
                done = True
            except Stopped:
                done = False
        assert rows(tables.read_if_there(spark, path, people)) == rows(batch)
        assert rows(sinks.full_refresh(tables.read_if_there(spark, path, people).where("id > 3"), path)) == rows(batch.where("id > 3"))
        if done:
            break
    assert done and at >= 4
    # one that is not whole is undone
    path = str(tmp_path / "half")
    sinks.full_refresh(people, path)
    (tmp_path / "half__next").mkdir()
    assert rows(tables.read_if_there(spark, path, people)) == rows(people) and not (tmp_path / "half__next").exists()


def test_client_table(spark, tmp_path):
    path = str(tmp_path / "clients")
    columns = plans.loads.spec.CLIENT_COLUMNS
    frame = lambda **changed: spark.createDataFrame([tuple({c: f"{c}{i}" for c in columns}[c] if c not in changed or i else changed[c] for c in columns) for i in range(3)], ", ".join(f"{c} string" for c in columns))
    plans.load_client_table(path, frame())
    loaded = plans.load_client_table(path, frame(nome="other", telefone="9"))
    first_row = loaded.where("cpf = 'cpf0'").first()
    assert first_row["nome"] == "other" and first_row["telefone"] == "telefone0" and loaded.count() == 3
