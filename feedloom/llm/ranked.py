"""Ranked lexical search by the Best Position Algorithm over impact lists.

A term is a run of digits, letters and characters above ASCII, A-Z in lower case.  With N documents that hold a
term, L terms in all of them, n in one, df documents that hold a term and tf of its occurrences in one:

    w = floor(1000 ln((2N + 2) / (2 df + 1)))      in doubles, all else in whole numbers
    m = 75 + 25 n N div L
    impact = w * (1000000000 tf div (1000 tf + 12 m))

and a document's score for an item sums the impacts of the item's terms, repeats included.

Documents are dealt into shards of about ``postings`` postings, and every item meets every shard, in blocks of
items.  A shard holds a list for each term, highest impact first.  An item's lists are read in step.  A document
met in one of them is looked up in all others (direct access), which gives its score and marks its position in
each list as seen.  A list's best position is the last one up to which all have been seen, so what no list has
shown yet scores at most the sum of the impacts at best positions.  Reading stops when that sum is strictly below
the ``k``-th score: documents of equal score have all been met then.  Of all shards' answers the ``k`` best stay.

Only postings of terms that items hold are kept: documents are read once, against a filter of ``FILTER_BITS`` bits
over the items' terms, and what the filter lets through by chance meets no item later.  The filter is all that is
sent to every task.  Postings are written to the shared folder, a row for each document, so a frequent term or a
document id of many rows gathers nowhere.  Terms are compared by 64-bit hashes.

Defined results: null and empty texts, and those without a term, are no documents; a row without ``doc_id`` counts
in N, L and df, but is not returned; repeated rows are documents of their own; the texts of one item id count as
one text, equal ones once; rows without an item id are no items; equal scores go by ascending id.  Other columns,
whatever their names, are not read.  Long texts are read whole, a document's postings at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.texts import WORD, chunks, words
from feedloom.session import work_path

K = 20
POSTINGS = 1 << 18  # of a shard
PAIRS = 1 << 17  # terms of the items of a block, repeats left out
FILTER_BITS = 22
STEP = 32  # positions read at first; each turn reads twice as many


def _counted(hashes: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and occurrences, by document."""
    order = np.lexsort((hashes, document))
    h, d = hashes[order], document[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])]) if len(h) else np.zeros(0, np.int64)
    return d[first], h[first], np.diff(np.r_[first, len(h)])


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, term, q``: how often each item holds each of its terms."""

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                w = words(chunk, WORD)
                document, term, q = _counted(w.hash, w.document())
                ids = batch.column(0).slice(chunk.rows.start, len(chunk)).take(pa.array(document))
                yield pa.record_batch([ids, pa.array(term.view(np.int64)), pa.array(q.astype(np.int64))], names=["item_id", "term", "q"])

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).where("item_id is not null").distinct()
    return rows.mapInArrow(run, "item_id long, term long, q long").groupBy("item_id", "term").agg(F.sum("q").alias("q"))


def _filter(terms: DataFrame) -> np.ndarray:
    """Which leading bits the terms' hashes have."""
    held = terms.select(F.shiftrightunsigned("term", 64 - FILTER_BITS).cast("int").alias("place")).distinct().toArrow()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[held["place"].to_numpy()] = True
    return bits


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``doc_id, nth, n, terms, tf`` of each document: its terms that pass the filter, and their occurrences.

    ``nth`` tells repeated rows apart.  Written to the shared folder.
    """
    packed = np.packbits(_filter(terms))

    def run(batches):
        wanted = np.unpackbits(packed).view(bool)
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                w = words(chunk, WORD)
                lengths = np.diff(w.first)
                inside = wanted[(w.hash >> np.uint64(64 - FILTER_BITS)).view(np.int64)]
                document, term, tf = _counted(w.hash[inside], w.document()[inside])
                some = np.flatnonzero(lengths)
                ends = np.searchsorted(document, np.r_[some, len(lengths)])
                ids = batch.column(0).slice(chunk.rows.start, len(chunk)).take(pa.array(some))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x)) for x in (term.view(np.int64), tf.astype(np.int32))]
                yield pa.record_batch([ids, pa.array(some), pa.array(lengths[some]), *lists], names=["doc_id", "nth", "n", "terms", "tf"])

    read = docs.select(F.col("doc_id").cast("long"), "text")
    path = work_path(docs.sparkSession, "postings")
    read.mapInArrow(run, "doc_id long, nth long, n long, terms array<long>, tf array<int>").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def weights(held: DataFrame, terms: DataFrame, documents: int) -> DataFrame:
    """``item_id, term, q, w`` of the terms that have a document and a weight."""
    counts = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    share = F.lit(2.0 * documents + 2.0) / (2.0 * F.col("df") + 1.0)
    weight = F.floor(1000.0 * F.log(share)).cast("long")
    return terms.join(counts, "term").select("item_id", "term", "q", weight.alias("w")).where("w > 0")


def _spans(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All whole numbers of the spans, one span after the other."""
    lengths = end - begin
    return np.arange(lengths.sum()) + np.repeat(begin - np.r_[0, np.cumsum(lengths)[:-1]], lengths) if len(begin) else np.zeros(0, np.int64)


class Shard:
    """Impact lists of the documents of a shard, by term and by document.

    ``ids`` rises; a posting is given by its document (a place in ``ids``), term (from 0) and impact.
    """

    def __init__(self, ids: np.ndarray, document: np.ndarray, term: np.ndarray, impact: np.ndarray, terms: int) -> None:
        self.ids = ids
        by_document = np.argsort(document, kind="stable")
        document, self.term, self.impact = document[by_document], term[by_document], impact[by_document]
        self.first = np.searchsorted(document, np.arange(len(ids) + 1))
        order = np.lexsort((document, -self.impact, self.term))
        self.place = np.empty(len(order), np.int64)  # of a posting, its place among all lists
        self.place[order] = np.arange(len(order))
        self.listed, self.falling = document[order], self.impact[order]
        self.start = np.searchsorted(self.term[order], np.arange(terms + 1))

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
        """The places in ``ids`` and scores of the ``k`` best documents, best first, and how many were scored."""
        begin, end = self.start[terms], self.start[terms + 1]
        factor = np.zeros(len(self.start), np.int64)
        factor[terms] = times
        scored, seen = np.zeros(len(self.ids), bool), np.zeros(len(self.listed), bool)
        reached, position = begin.copy(), begin.copy()  # read so far; the first one not seen
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while (reached < end).any():
            read = _spans(reached, np.minimum(reached + step, end))
            reached = np.minimum(reached + step, end)
            step *= 2
            seen[read] = True
            met = self.listed[read]
            met = np.unique(met[~scored[met]])
            scored[met] = True
            looked = _spans(self.first[met], self.first[met + 1])
            own = np.repeat(np.arange(len(met)), self.first[met + 1] - self.first[met])
            hit = factor[self.term[looked]] > 0
            looked, own = looked[hit], own[hit]
            seen[self.place[looked]] = True
            if len(met):
                total = np.add.reduceat(self.impact[looked] * factor[self.term[looked]], np.searchsorted(own, np.arange(len(met))))
                found, scores = np.r_[found, met], np.r_[scores, total]
                kept = np.lexsort((found, -scores))[:k]
                found, scores = found[kept], scores[kept]
            for i in range(len(terms)):
                ahead = seen[position[i]:end[i]]
                gap = int(ahead.argmin()) if len(ahead) else 0
                position[i] = end[i] if len(ahead) and ahead[gap] else position[i] + gap
            open_ = position < end
            bound = int((self.falling[position[open_] - 1] * times[open_]).sum())
            if len(found) == k and bound < scores[-1]:
                break
        some = scores > 0
        return found[some], scores[some], int(scored.sum())


def impacts(tf: np.ndarray, n: np.ndarray, w: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The impact of each posting, in whole numbers."""
    if int(n.max(initial=0)) * 25 * documents >= 1 << 63:
        m = np.array([75 + 25 * int(x) * documents // total for x in n], np.int64)
    else:
        m = 75 + 25 * n * documents // total
    return w * (1_000_000_000 * tf // (1000 * tf + 12 * m))


def search(docs: DataFrame, items: DataFrame, k: int = K, shard_postings: int = POSTINGS, block_pairs: int = PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents of each item."""
    spark = docs.sparkSession
    path = work_path(spark, "terms")
    item_terms(items).write.parquet(path)
    terms = spark.read.parquet(path)
    held = postings(docs, terms)
    sums = held.agg(F.count("*").alias("N"), F.sum("n").alias("L"), F.sum(F.size("terms")).alias("p")).first()
    documents, total = sums["N"], sums["L"] or 1
    shards = -(-(sums["p"] or 0) // shard_postings) or 1
    path = work_path(spark, "items")
    weights(held, terms, documents).write.parquet(path)
    asked = spark.read.parquet(path)
    blocks = -(-asked.count() // block_pairs) or 1
    shard = F.pmod(F.xxhash64("doc_id", "nth"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = held.where("doc_id is not null and size(terms) > 0").select("doc_id", "n", "terms", "tf", shard.alias("shard")).withColumn("block", every(blocks))
    right = asked.select("item_id", "term", "q", "w", block.alias("block")).withColumn("shard", every(shards))
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def answer(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return schema.empty_table()
        rows = rows.sort_by("doc_id").combine_chunks()
        lists = rows["terms"].combine_chunks()
        hashes, tf = lists.flatten().to_numpy(), rows["tf"].combine_chunks().flatten().to_numpy().astype(np.int64)
        document = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        wanted = asked["term"].to_numpy()
        known, first = np.unique(wanted, return_index=True)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        kept = np.flatnonzero(known[at] == hashes)
        document, term = document[kept], at[kept]
        impact = impacts(tf[kept], rows["n"].to_numpy()[document], asked["w"].to_numpy()[first][term], documents, total)
        index = Shard(rows["doc_id"].to_numpy(), document, term, impact, len(known))
        order = np.argsort(asked["item_id"].to_numpy(), kind="stable")
        ids, terms, times = asked["item_id"].to_numpy()[order], np.searchsorted(known, wanted[order]), asked["q"].to_numpy()[order]
        edges = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1], True])
        found = []
        for a, b in zip(edges[:-1], edges[1:]):
            places, scores, _ = index.best(terms[a:b], times[a:b], k)
            found.append((np.full(len(places), ids[a]), index.ids[places], scores))
        return pa.table([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found)], schema=schema)

    answers = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(answer, "item_id long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return answers.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
