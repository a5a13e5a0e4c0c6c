from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedloom.operators import joins
from tests.conftest import rows


def table(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "k int")


@pytest.mark.parametrize("left, right, expected", [
    ([1, 2, None], [2], [(1,)]), ([1, 2, None], [2, None], []), ([1, None], [], [(None,), (1,)]), ([1], [None], []),
])
def test_not_in_is_the_sql_predicate(spark, left, right, expected):
    source, target = table(spark, *left), table(spark, *right)
    source.createOrReplaceTempView("l")
    target.createOrReplaceTempView("r")
    assert rows(joins.not_in(source, target, "k")) == expected
    assert rows(spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT k FROM r)")) == expected


def test_new_rows_keep_null_keys(spark):
    assert rows(joins.new_rows(table(spark, 1, 2, 2, None), table(spark, 1, 1, None), "k")) == [(None,), (2,), (2,)]


def test_current_version_is_a_condition_of_the_join(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "cpf string, n int")
    dim = spark.createDataFrame([("a", 10, None), ("a", 9, "x"), ("b", 8, "x"), ("a", 11, None)], "cpf string, sk int, end string")
    found = joins.join_current(fact, dim, "cpf", "end", ["sk"])
    assert rows(found, "n", "sk") == [(1, 10), (1, 11), (2, None), (3, None)]


def test_suffix_match(spark):
    events = spark.createDataFrame(
        [("e1", "Home x Away", "d"), ("e2", "Parking AWAY", "d"), ("e3", "Home X Away", "f"), ("e4", None, "d")],
        "id string, title string, day string")
    day = F.col("day")

    def ids(probe, **options):
        one = spark.createDataFrame(probe, "title string, day string")
        return [r[0] for r in rows(joins.match_by_suffix(events, "title", day, one, "title", day, **options), "id")]

    assert ids([("Home X Away", "d")]) == ["e1", "e2"]
    # Without the separator the suffix is empty, which every title contains.
    assert ids([("Home", "d")]) == ["e1", "e2"]
    assert ids([("Home", "d")], require_suffix=True) == []
    assert ids([]) == []


def test_outer_chain_does_not_match_null_keys(spark):
    def part(name, *values):
        return spark.createDataFrame(values, f"day string, city string, {name} int")

    chained = joins.outer_chain(
        [part("a", ("d", "x", 1), ("d", None, 2)), part("b", ("d", "x", 3), ("d", None, 4)), part("c", ("d", "y", 5))], ["day", "city"])
    assert rows(chained) == [
        ("d", None, None, 4, None), ("d", None, 2, None, None), ("d", "x", 1, 3, None), ("d", "y", None, None, 5)]


def test_expand_by_ids_returns_rows_outside_the_window(spark):
    frame = spark.createDataFrame([(1, "p"), (5, "p"), (9, "q"), (2, None), (9, None)], "t int, id string")
    assert rows(joins.expand_by_ids(frame, F.col("t") < 3, "id")) == [("p", 1), ("p", 5)]


def test_enrich_priority(spark):
    fact = spark.createDataFrame([(1, "a", "own"), (2, "b", "own"), (3, "c", "own")], "event int, cpf string, own string")
    events = spark.createDataFrame([(1, "m"), (2, "m")], "event int, title string")
    first = spark.createDataFrame([("a", "first")], "cpf string, one string")
    second = spark.createDataFrame([("a", "second"), ("a", "again")], "cpf string, two string")
    found = joins.enrich_priority(fact, events, "event", [(first, "cpf"), (second, "cpf")], {"name": ["one", "two", "own"]})
    assert rows(found, "event", "name", "two") == [(1, "first", "again"), (1, "first", "second"), (2, "own", None)]


def test_salted_join_is_a_left_join_and_spreads_the_hot_key(spark):
    """Half of the facts carry the sentinel; at default thresholds no task holds that half."""
    from pyspark.sql import functions as F

    from feedloom.operators.joins import left_join_salted

    facts = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, F.lit("-1")).when(F.col("id") % 97 != 0, F.col("id").cast("string")).alias("cpf"))
    dim = spark.range(20_000).select((F.col("id") * 3).cast("string").alias("cpf"), F.col("id").alias("sk"))
    dim = dim.union(spark.createDataFrame([("-1", 1_000_000), ("-1", 1_000_001)], dim.schema))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these tables are small enough for one task
    try:
        found = left_join_salted(facts, dim, "cpf", ["-1"])
        wanted = facts.join(dim, "cpf", "left")
        assert found.columns == wanted.columns
        assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
        parts = found.where("cpf = '-1'").groupBy(F.spark_partition_id().alias("p")).count()
        largest = parts.agg(F.max("count")).first()[0]
        assert largest < 0.5 * parts.agg(F.sum("count")).first()[0]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(cpf" in plan and "_salt" in plan.split("hashpartitioning(cpf", 1)[1][:40]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_suffix_wildcards_match_as_in_sql(spark):
    from pyspark.sql import functions as F

    from feedloom.operators.joins import match_by_suffix

    events = spark.createDataFrame([("A x Boa Vista", 1), ("B x Bo- Vista", 1), ("C x Boa\\ Vista", 1), ("D x Bo Vista", 1), ("E x Boa Vista", 2)], "title string, day int")
    probe = spark.createDataFrame([("Home X Bo_ vista", 1)], "title string, day int")
    found = match_by_suffix(events, "title", F.col("day"), probe, "title", F.col("day"))
    assert sorted(r.title for r in found.collect()) == ["A x Boa Vista", "B x Bo- Vista"]


def test_hot_keys_are_found_and_spread(spark):
    """A third of the rows under a key that nobody names, and it stands in no single task."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name, None) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        key = F.when(F.col("id") % 3 == 0, F.lit(4711)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id"))
        fact = spark.range(0, 60_000, 1, 4).select(key.alias("k"), F.col("id").alias("x"))
        dim = spark.range(0, 60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d")).union(spark.createDataFrame([(4711, -1)], "k long, d long"))
        hot = joins.hot_keys(fact, "k")
        assert fact.select(hot.alias("hot")).first()["hot"] == [4711]
        joined = joins.left_join_salted(fact, dim, "k", hot)
        plain = fact.join(dim, "k", "left")
        assert joined.exceptAll(plain.select(*joined.columns)).isEmpty() and joined.count() == plain.count() == 80_001
        largest = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert largest(plain) > 40_000 > 3 * largest(joined)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_no_hot_keys(spark):
    fact = spark.range(1000).select(F.col("id").alias("k"))
    assert fact.limit(1).select(joins.hot_keys(fact, "k").alias("hot")).first()["hot"] == []
    none = fact.where("false")
    assert joins.left_join_salted(none, fact.withColumn("d", F.lit(1)), "k", joins.hot_keys(none, "k")).count() == 0


@pytest.mark.parametrize("require", [False, True])
def test_suffixes_of_many_probes(spark, require):
    titles = ["Fla X Vasco", "FLA X VASCO DA GAMA", "Flu X Santos", "other", "a X b", "100% X é", None, "Vasco", "ab_cd", "axcd", "santos santos"]
    events = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(titles * 2)] + [(99, "Vasco", None)], "id int, title string, day int")
    asked = [("x X vasco", 0), ("x X vasco", 0), ("x X vasco", 1), ("no separator", 0), ("y X B", 0), ("z X 0% X", 1), ("w X b_c", 0), ("w X b_c", 1), ("v X unheard", 0), ("u X va%co", 1), (None, 1), ("q X vasco", None), ("t X %%%", 1)]
    probes = spark.createDataFrame(asked, "name string, on int")
    found = joins.match_suffixes(events, "id", "title", F.col("day"), probes, "name", F.col("on"), require_suffix=require)
    expected = []
    for probe in probes.distinct().collect():
        one = spark.createDataFrame([tuple(probe)], probes.schema)
        hits = joins.match_by_suffix(events, "title", F.col("day"), one, "name", F.col("on"), require_suffix=require).collect()
        expected += [(probe["name"], probe["on"], r["id"]) for r in hits]
    assert sorted(map(tuple, found.collect())) == sorted(expected) and len(expected) > 10
