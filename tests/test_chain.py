"""The chain of one run: what it computes, shuffles and writes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedloom import plans
from feedloom.plans.loads import CATALOGUE_USED
from feedloom.sinks import versions
from feedloom.specs import tickets as spec
from tests.conftest import rows


def staged(spark, n, matches):
    """Tickets of matches ``m0`` to ``m{matches - 1}`` and one without a match."""
    frame = spark.range(n).withColumns({name: F.lit("x") for name in spec.STAGED})
    return frame.withColumns({
        "cod_evento": F.when(F.col("id") > 0, F.concat(F.lit("m"), (F.col("id") % matches).cast("string"))),
        "cpf": F.when(F.col("id") % 9 > 0, (F.col("id") % 11).cast("string")),
        "ingresso": F.col("id").cast("string"), "usado": F.lit(True), "flag_cpf_portador": F.lit(False),
    }).drop("id")


@pytest.fixture
def inputs(spark):
    catalogue = spark.createDataFrame([(f"m{i}", f"A x B{i}", "CUP", f"2024-01-{1 + i % 5:02d}", "16:00") for i in range(20)], ", ".join(f"{c} string" for c in CATALOGUE_USED))
    people = spark.createDataFrame([(str(i), i, f"p{i}", f"p{i}@mail" if i % 2 else None, None if i % 3 else "1999") for i in range(11)], "cpf string, sk_pessoa int, nome string, email string, load_end_date string")
    contracts = spark.createDataFrame([("1", 7), ("2", 8)], "cpf string, sk_contrato int")
    clients = spark.createDataFrame([("4", "c4", "c4@shop"), ("2", "c2", None)], "cpf string, nome string, email string")
    return catalogue, people, contracts, clients


def plain(stage, catalogue, people, contracts, clients):
    return rows(plans.build_fact(stage, people, contracts)), rows(plans.build_integration(stage, catalogue, people, clients))


@pytest.mark.parametrize("few", [versions.FEW_KEYS, 0])
def test_the_chain_gives_the_plain_rows(spark, tmp_path, monkeypatch, inputs, few):
    """With dimensions that are broadcast and with others; a reprocessed match gives way, others stay."""
    monkeypatch.setattr(versions, "FEW_KEYS", few)
    stage = staged(spark, 300, 25)
    first = plans.load_all(str(tmp_path), stage, *inputs)
    assert (rows(first["fact"]), rows(first["integration"])) == plain(stage, *inputs)
    changed = stage.withColumn("valor", F.lit("new"))
    chosen = F.coalesce(F.col("cod_evento").isin("m1", "m6", "m11", "m16"), F.lit(False))  # of 2024-01-02
    days = plans.events_of_dates(inputs[0], ["2024-01-02"])
    again = plans.load_all(str(tmp_path), changed, *inputs, days)
    now = stage.where(~chosen).unionByName(changed.where(chosen))
    assert rows(again["stage"]) == rows(now)
    assert (rows(again["fact"]), rows(again["integration"])) == plain(now, *inputs)


def test_the_chain_computes_its_catalogue_once_and_shuffles_tickets_once(spark, tmp_path, monkeypatch, inputs):
    """Fact and feed are written in the order of the staged files, which are gathered by match."""
    seen, written = [], versions._written
    marked = inputs[0].withColumn("CAMPEONATO", F.concat("CAMPEONATO", F.lit(" costly")))

    def watch(frame, *args):
        seen.append(frame._jdf.queryExecution().executedPlan().toString())
        return written(frame, *args)

    monkeypatch.setattr(versions, "_written", watch)
    plans.load_all(str(tmp_path), staged(spark, 300, 25), marked, *inputs[1:])
    assert sum(" costly" in plan for plan in seen) == 1
    wide = [plan for plan in seen if "portao_acesso" in plan]
    assert len(wide) == 3  # stage, fact, feed
    assert [("Exchange hashpartitioning" in plan, "Exchange REBALANCE" in plan or "rebalance" in plan.lower()) for plan in wide[1:]] == [(False, False)] * 2
    plans.load_all(str(tmp_path), staged(spark, 300, 25), marked, *inputs[1:], plans.events_of_dates(marked, ["2024-01-02"]))
    assert sum(" costly" in plan for plan in seen) == 2


@pytest.mark.parametrize("by", [versions.ByKey("id"), versions.ByDay("at")])
def test_the_list_names_rows_and_buckets_of_files(spark, tmp_path, by):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(i % 30 if i % 7 else None, f"2024-01-{1 + i % 9:02d}") for i in range(200)], "id int, at string")
    versions.load_full(frame, path, by, 40)
    listed = versions.manifest(spark, path, versions.version(spark, path)).collect()
    assert len(listed) >= 5 and sum(r["rows"] for r in listed) == 200
    for r in listed:
        held = spark.read.schema(frame.schema).parquet(f"{path}/{r['file']}").select(by.bucket().alias("b")).collect()
        assert (r["rows"], sorted(r["buckets"])) == (len(held), sorted({h["b"] for h in held}))


def test_no_stage_is_generated_as_a_method_that_the_jvm_does_not_compile(spark):
    """A stage whose code is longer is run operator by operator, with the same rows."""
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000
    events = spark.range(60).selectExpr(
        "CAST(id AS STRING) AS event_id", "concat(lpad(1 + id % 9, 2, '0'), '/03/2024') AS event_date", "'16:00' AS event_time", "'Ação x B' AS `match`",
        "if(id % 3 = 0, 'Outro', ' maracanã ') AS stadium", "if(id % 5 = 0, 'nbb', 'Copa') AS championship", *[f"'x' AS {c}" for c in ("sales_start_date", "sales_start_time", "public_sale_start_date", "public_sale_start_time", "sales_end")],
    )
    found = plans.clean_events(events).select("COD_EVENTO", "DT_EVENTO", "PARTIDA")
    assert rows(found) == sorted((str(i), f"2024-03-{1 + i % 9:02d}", "ACAO X B") for i in range(60) if i % 3 and i % 5)
