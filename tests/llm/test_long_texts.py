"""Very long texts, mark-up that nothing closes, and columns with names the operators use."""

from __future__ import annotations

import re
import time

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.llm import decontamination, order_minhash, packing, toxicity, warc

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# The same rules as patterns that start again after every failed match, right on short pages.
HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.I | re.S)
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.I | re.S)
CHARSET = re.compile(r"<meta\b[^>]*charset\s*=\s*[\"']?([\w-]+)", re.I)
LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PARTS = ["<a", " href", "=", '"', "'", ">", "<", "x", " ", "<!--", "-->", "<script", "</script>", "<title>", "</title>", "<meta charset=", "utf-8", "<p>", "</a >", "/"]


@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
@settings(max_examples=1500, deadline=None)
def test_pages_are_read_as_by_patterns(page):
    assert warc._visible(page) == HIDDEN.sub("", page)
    title, charset = TITLE.search(page), CHARSET.search(page)
    assert warc._title(page) == (title[1] if title else None)
    assert (warc._charset(page) or None) == (charset[1] if charset else None)
    assert warc._links(page) == [a or b or c for a, b, c in LINK.findall(page)]
    assert warc._without_tags(page, "\n") == warc._TAG.sub("", warc._BLOCK.sub("\n", page))


def test_unclosed_markup_takes_linear_time():
    for part in ("<a", "<a href", "<a href=", "<script", "<title>", "<title", "<meta", "<p", "<", "<!--", "<a href='"):
        for end in ("", ">"):
            page = part * (1_000_000 // len(part)) + end
            started = time.process_time()
            warc.plain_text(page), warc._metadata("HTTP/1.1 200 OK\r\n", page)
            assert time.process_time() - started < 10, part


def test_long_runs_of_space_are_packed(spark):
    texts = [" " * 2_000_000, "word" + "\n" * 200_000 + "word", "a" * 300_000, "short"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    exact = __import__("tokenizers").Tokenizer.from_file(VOCABULARY)
    counts = {r["doc_id"]: r["n"] for r in packing.pack(docs, VOCABULARY).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert counts == {i: len(exact.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def test_clashing_names_pass_through(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (1, base), (2, base + " tail"), (3, "other words than those of the first one"), (4, None), (None, base), (3, "other words than those of the first one")]
    names = ["_words", "_hash", "id", "row", "hash", "again", "some", "_id", "_row", "_scored_text", "score"]
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in rows], "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    kept = order_minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted([(0, base), (1, base), (3, rows[3][1]), (4, "")])
    assert {tuple(r[n] for n in names) for r in kept.collect()} == {tuple(range(len(names)))}
    held = toxicity.reject(docs, toxicity.Model(intercept=-30.0), 0.3)
    assert held.columns == docs.columns and sorted(map(str, held.collect())) == sorted(map(str, docs.collect()))
    benchmark = spark.createDataFrame([(7, base)], "item_id long, text string")
    clean = decontamination.clean(docs, benchmark)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {3, 4}
