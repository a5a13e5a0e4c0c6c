"""One query per operator over the given tables, with production settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import decontamination, licenses, neighbours, ngrams, order_minhash, pieces, quality, ranked, repeats, toxicity, warc, whitening
from feedloom.llm.packing import pack

QUERIES = {}
ORACLE = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fold(folds: int):
    """The part of the rows that a document's id falls into; none for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


@query
def op1_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.matches(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.drop("text_hash")


@query
def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = order_minhash.classes(read(spark, folder, "documents"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    found = licenses.summarise(licenses.scan(docs, licenses.frequencies(docs), "doc_id"))
    return found.withColumn("score", F.round("score", 9))


def _licence_sql(templates: list[licenses.Template]) -> str:
    """The scan as SQL, the templates written out as rows."""
    phrases, words = [], []
    for number, t in enumerate(templates):
        for k, phrase in enumerate(t.phrases):
            ws = ", ".join(f"'{w}'" for _, w in phrase)
            phrases.append(f"({number}, {k}, {phrase[0][0]}, {t.slack}, {len(t.phrases)}, '{t.label}', {str(t.base).lower()}, [{ws}])")
        words += [f"({number}, {at}, {t.slack}, '{w}')" for at, w in enumerate(t.words)]
    return f"""
    WITH phrases(t, k, off, slack, n, label, base, ws) AS (VALUES {", ".join(phrases)}),
    shown(t, place, slack, word) AS (VALUES {", ".join(words)}),
    docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    tokens AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS place FROM docs),
    dfs AS (SELECT v.word, count(DISTINCT r) AS df FROM (SELECT DISTINCT word FROM shown) v LEFT JOIN tokens USING (word) GROUP BY v.word),
    idfs AS (SELECT word, ln(CAST((SELECT count(*) FROM docs) + 1 AS DOUBLE) / (df + 1)) + 1 AS idf FROM dfs),
    weights AS (SELECT t, place, slack, word, idf / sum(idf) OVER (PARTITION BY t) AS weight FROM shown JOIN idfs USING (word)),
    occurrences AS (SELECT p.t, p.k, p.slack, p.n, p.label, p.base, r, x.place - p.off AS start
        FROM tokens x JOIN phrases p ON x.word = p.ws[1] JOIN docs USING (r) WHERE list_slice(w, x.place + 1, x.place + len(p.ws)) = p.ws),
    standing AS (SELECT a.r, a.t, a.label, a.base, a.start FROM occurrences a JOIN occurrences o ON o.r = a.r AND o.t = a.t AND abs(o.start - a.start) <= a.slack
        WHERE a.k = 0 GROUP BY ALL HAVING count(DISTINCT o.k) = any_value(a.n)),
    scored AS (SELECT r, t, label, base, start, sum(CASE WHEN start + place + slack >= 0
            AND list_contains(list_slice(w, greatest(start + place + 1 - slack, 1), start + place + 1 + slack), word) THEN weight ELSE 0 END) AS score
        FROM standing JOIN weights USING (t) JOIN docs USING (r) GROUP BY r, t, label, base, start),
    summed AS (SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(least(score, 1.0)) AS score
        FROM scored GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
        coalesce(labels, '') AS labels, round(coalesce(score, 0.0), 9) AS score
    FROM docs LEFT JOIN summed USING (r)"""


ORACLE["op3_license_scan"] = _licence_sql(licenses.TEMPLATES)


@query
def op4_ngram_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").withColumn("held_out", F.coalesce(fold(5) == 1, F.lit(False)))
    model = ngrams.fit(docs.where("not held_out"))
    return ngrams.score(docs, model, "doc_id", "held_out")


@query
def op5_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.removals(read(spark, folder, "documents"))


TOXIC_AT = 0.3


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, labels.where(fold(4) != 2))


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").withColumn("held_out", F.coalesce(fold(4) == 2, F.lit(False)))
    scored = toxicity.score(docs, fit_toxicity(docs, read(spark, folder, "labels")), "doc_id", "held_out")
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_AT).cast("int"))


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").withColumn("held_out", F.coalesce(fold(4) == 2, F.lit(False)))
    model = quality.fit(docs, read(spark, folder, "labels").where(fold(4) != 2))
    return quality.score(docs, model, "doc_id", "held_out").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = neighbours.usable(read(spark, folder, "embeddings"))
    return neighbours.search(neighbours.build_index(rows), rows.where(F.col("id") % 20 == 0))


@query
def op9_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.derivatives(warc.responses(read(spark, folder, "pages")))
    return records.select("*", F.array_join(F.transform("fields", lambda f: F.concat_ws(": ", f["name"], f["value"])), "\n").alias("header")).drop("fields")


@query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return pack(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op11_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


ORACLE["op11_ranked"] = """
    WITH held AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
        FROM documents),
    docs AS (SELECT r, doc_id, terms, len(terms) AS n FROM held WHERE len(terms) > 0),
    totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM docs),
    tfs AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL),
    dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
    asked AS (SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL)),
    weighed AS (
        SELECT item_id, term, count(*) AS q, CAST(floor(1000.0 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / CAST(2 * any_value(df) + 1 AS DOUBLE))) AS BIGINT) AS w
        FROM asked JOIN dfs USING (term), totals GROUP BY item_id, term),
    scored AS (
        SELECT item_id, r, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // nt)))) AS BIGINT) AS score
        FROM weighed JOIN tfs USING (term), totals GROUP BY item_id, r, doc_id),
    placed AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
        FROM scored WHERE score > 0 AND doc_id IS NOT NULL)
    SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= 20"""


@query
def op12_pieces(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    encoded = pieces.encode(read(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), "doc_id")
    return pieces.digests(encoded)


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read(spark, folder, "embeddings"))
