"""Benchmark decontamination by latent semantic retrieval.

1. The words of the benchmark are the terms.  Texts are cut into blocks of ``STRIDE`` words, and two blocks
   are a passage; what a passage holds of the terms is its TF-IDF row.
2. A randomised SVD of these rows, the benchmark's own added, gives the latent space: every task multiplies
   its rows by the same random matrix and back by their transpose, the sums meet in Spark, and the small
   remainder (terms by ``rank``) is solved on the driver.
3. Each passage is compared with each benchmark piece by the cosine in that space.
4. A passage near enough is aligned with the piece: the longest common subsequence of words, within the
   passage and a block on either side.  ``COPY`` of the piece's words in order make a copy.  ``PARAPHRASE``
   of them make a paraphrase if as much is there by weight of the words, so that frequent words alone don't
   count, and if the answer (the column of that name, else the item's last words) is there too, by weight.

Benchmark items are a stated query set: they meet all texts in blocks of at most ``BLOCK_PIECES`` pieces and
about ``BLOCK_TERMS`` terms, which bounds what every task holds.  Items longer than a passage are cut into
pieces, each of which counts.

Defined results: upper case A-Z and punctuation don't count; items of fewer than ``SHORT`` words match only
as they are; items and texts without words match nothing; repeated rows give one match per document, item
and text; rows without an id are matched too.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.texts import WORD, chunks, small_batches, words
from feedloom.session import work_path

STRIDE = 32
PASSAGE = 2 * STRIDE
RANK = 256
OVERSAMPLE = 16
COSINE = 0.4
COPY = 0.8
PARAPHRASE = 0.5
ANSWER = 0.7
SHORT = 8
BLOCK_PIECES = 256
BLOCK_TERMS = 32_768
HITS = 40_000  # that a task works on at a time
COMMON = 128  # terms whose counts are held as a dense matrix
TERM_PART = 256  # terms whose sums travel together
SALT = 64


class Block:
    """Benchmark pieces that are searched for together, as numbers of terms."""

    def __init__(self, pieces: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        self.items = np.array([item for item, _, _ in pieces], np.int64)
        self.terms = np.unique(np.concatenate([h for _, a, b in pieces for h in (a, b)]))
        self.pieces = [np.searchsorted(self.terms, a) for _, a, _ in pieces]
        self.answers = [np.unique(np.searchsorted(self.terms, b)) for _, _, b in pieces]

    def rows(self, weight: np.ndarray) -> np.ndarray:
        """The pieces' own TF-IDF rows, of length one."""
        found = np.zeros((len(self.pieces), len(self.terms)))
        for row, piece in zip(found, self.pieces):
            np.add.at(row, piece, weight[piece])
        return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)


def blocks(benchmark: DataFrame) -> list[Block]:
    """The benchmark, cut into pieces and dealt into blocks in order of the items' ids."""
    named = [c for c in ("item_id", "text", "answer") if c in benchmark.columns]
    table = benchmark.where("item_id is not null and text is not null").select(*named).distinct().orderBy(*named).toArrow()
    if not table.num_rows:
        return []
    hashes = _word_lists(table["text"].combine_chunks())
    answers = _word_lists(table["answer"].combine_chunks()) if "answer" in named else [h[-max(3, len(h) // 4):] for h in hashes]
    dealt: list[list] = [[]]
    size = 0
    for item, own, answer in zip(table["item_id"].to_pylist(), hashes, answers):
        count = -(-len(own) // PASSAGE)
        for part in np.array_split(own, count) if count else []:
            if len(dealt[-1]) == BLOCK_PIECES or (size and size + len(part) > BLOCK_TERMS):
                dealt.append([])
                size = 0
            # of an item in several pieces each has to carry its own end
            dealt[-1].append((item, part, answer if count == 1 else part[-max(3, len(part) // 4):]))
            size += len(part)
    return [Block(d) for d in dealt if d]


def _word_lists(column: pa.Array) -> list[np.ndarray]:
    return [h for c in chunks(column) for w in [words(c, WORD)] for h in np.split(w.hash, w.first[1:-1])]


def _hits(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """``doc_id, text_hash, n, places, terms`` of the texts that hold any term, in order of the words."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("places", pa.binary()), ("terms", pa.binary())])

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                found = words(chunk, WORD)
                at = np.minimum(np.searchsorted(terms, found.hash), len(terms) - 1)
                hit = np.flatnonzero(terms[at] == found.hash)
                edges = np.searchsorted(hit, found.first)
                rows = np.flatnonzero(np.diff(edges))
                place = (hit - np.repeat(found.first[:-1], np.diff(edges))).astype(np.uint32)
                term = at[hit].astype(np.uint32)
                cut = lambda x: pa.array([x[edges[r]:edges[r + 1]].tobytes() for r in rows], pa.binary())
                keep = pa.array(rows + chunk.rows.start)
                yield pa.record_batch([batch.column(0).take(keep), batch.column(1).take(keep), pa.array(np.diff(found.first)[rows]), cut(place), cut(term)], schema=schema)

    read = small_batches(docs).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return read.mapInArrow(run, "doc_id long, text_hash long, n long, places binary, terms binary")


def _segments(batch: pa.RecordBatch):
    """Rows of a batch with about ``HITS`` hits: rows, first hit of each, place, term, number of blocks."""
    places = [np.frombuffer(b.as_buffer(), np.uint32).astype(np.int64) for b in batch.column(3)]
    terms = [np.frombuffer(b.as_buffer(), np.uint32).astype(np.int64) for b in batch.column(4)]
    counts = -(-batch.column(2).to_numpy() // STRIDE)
    first, held = 0, 0
    for i in range(batch.num_rows):
        held += len(terms[i])
        if held >= HITS or i + 1 == batch.num_rows:
            edges = np.r_[0, np.cumsum([len(t) for t in terms[first:i + 1]])]
            yield first, edges, np.concatenate(places[first:i + 1]), np.concatenate(terms[first:i + 1]), counts[first:i + 1]
            first, held = i + 1, 0


def _block_numbers(edges: np.ndarray, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hit, numbered through the segment, and each row's first block; one more at the end."""
    firsts = np.r_[0, np.cumsum(counts)]
    return np.repeat(firsts[:-1], np.diff(edges)) + places // STRIDE, firsts


def _frequencies(hits: DataFrame, size: int) -> np.ndarray:
    """How many texts hold each term."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for b in batch.column(0):
                total[np.unique(np.frombuffer(b.as_buffer(), np.uint32))] += 1
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["term", "n"])

    found = hits.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a row per term at most
    total = np.zeros(size, np.int64)
    total[found["term"].to_numpy()] = found["n"].to_numpy()
    return total


def _add_rows(total: np.ndarray, to: np.ndarray, rows: np.ndarray, source: np.ndarray) -> None:
    """Add rows[source] to total[to], one row for each place at a time, which numpy does in whole rows."""
    order = np.argsort(to, kind="stable")
    heads = np.flatnonzero(np.r_[True, np.diff(to[order]) != 0]) if len(to) else np.zeros(0, np.int64)
    nth = np.arange(len(to)) - np.repeat(heads, np.diff(np.r_[heads, len(to)]))
    by = np.argsort(nth, kind="stable")
    ends = np.cumsum(np.bincount(nth)) if len(nth) else []
    for a, b in zip([0, *ends], ends):
        part = order[by[a:b]]
        total[to[part]] += rows[source[part]]


class Rows:
    """The term counts of a segment's blocks: a dense matrix of the few most frequent terms, which hold most
    hits, and the other hits one by one."""

    def __init__(self, terms: np.ndarray, block: np.ndarray, n: int, common: np.ndarray) -> None:
        self.n, self.common = n, common
        place = np.full(int(max(terms.max(initial=0), common.max(initial=0))) + 1, -1)
        place[common] = np.arange(len(common))
        often = place[terms] >= 0
        at = block[often] * len(common) + place[terms[often]]
        self.counts = np.bincount(at, minlength=n * len(common)).reshape(n, len(common)).astype(np.float32)
        self.terms, self.block = terms[~often], block[~often]

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """Blocks by columns of the matrix, which has a row per term."""
        result = self.counts @ matrix[self.common]
        _add_rows(result, self.block, matrix, self.terms)
        return result

    def back(self, image: np.ndarray, total: np.ndarray) -> None:
        """Add the transpose times a matrix with a row per block to the total, which has a row per term."""
        total[self.common] += self.counts.T @ image
        _add_rows(total, self.terms, image, self.block)


def _latent_space(hits: DataFrame, own: np.ndarray, weight: np.ndarray, common: np.ndarray, rank: int, seed: int = 0) -> np.ndarray:
    """Terms by ``rank``: the leading right singular vectors of the rows of all blocks and the benchmark's.

    One pass: with a random O, the sum of A'(A O) over all tasks gives the Nystroem factors of A'A.
    """
    size = own.shape[1]
    width = min(rank + OVERSAMPLE, size)
    random = np.random.default_rng(seed).standard_normal((size, width)).astype(np.float32)
    weighted = (random * weight[:, None]).astype(np.float32)

    def run(batches):
        total = np.zeros((size, width), np.float32)
        for batch in batches:
            for _, edges, places, terms, counts in _segments(batch):
                block, firsts = _block_numbers(edges, places, counts)
                square = np.bincount(block, weight[terms] ** 2, firsts[-1])
                own_rows = Rows(terms, block, firsts[-1], common)
                image = own_rows.times(weighted) / np.maximum(square, 1e-12)[:, None].astype(np.float32)  # rows of length one, twice
                own_rows.back(image, total)
        total *= weight[:, None].astype(np.float32)
        rows = range(0, size, TERM_PART)
        yield pa.record_batch([pa.array(rows, pa.int32()), pa.array([total[a:a + TERM_PART].tobytes() for a in rows], pa.binary())], names=["part", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.float32).astype(np.float64) for b in group["sums"].to_pylist())
        return pa.table([group["part"][:1], pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["part", "sums"])

    sums = hits.mapInArrow(run, "part int, sums binary").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALT)))
    sums = sums.groupBy("part", "salt").applyInArrow(lambda g: add(g), "part int, sums binary").groupBy("part").applyInArrow(lambda g: add(g), "part int, sums binary")
    image = np.zeros((size, width))
    for row in sums.toArrow().to_pylist():  # terms by width numbers in all
        part = np.frombuffer(row["sums"], np.float32).reshape(-1, width)
        image[row["part"]:row["part"] + len(part)] = part
    image += own.T @ (own @ random) * max(np.abs(image).max(initial=0.0), 1.0)
    shift = 1e-6 * np.linalg.norm(image)
    image += shift * random
    core = random.T.astype(np.float64) @ image
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    half = vectors / np.sqrt(np.maximum(values, values.max(initial=1.0) * 1e-10))
    left, _, _ = np.linalg.svd(image @ half, full_matrices=False)
    return left[:, :rank]


def common_words(piece: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, a word of the text at a time over the piece's bits."""
    bits: dict[int, int] = {}
    for i, t in enumerate(piece.tolist()):
        bits[t] = bits.get(t, 0) | 1 << i
    full = (1 << len(piece)) - 1
    row = full
    for t in text.tolist():
        hit = row & bits.get(t, 0)
        row = (row + hit | row - hit) & full
    return len(piece) - row.bit_count()


def _judge(piece: np.ndarray, answer: np.ndarray, weight: np.ndarray, terms: np.ndarray, places: np.ndarray) -> tuple[str | None, float]:
    """Copy, paraphrase or nothing, and the share of the piece's words found in order."""
    if len(piece) < SHORT:
        runs = [i for i in range(len(terms) - len(piece) + 1) if (terms[i:i + len(piece)] == piece).all() and places[i + len(piece) - 1] - places[i] == len(piece) - 1]
        return ("copy", 1.0) if runs else (None, 0.0)
    share = common_words(piece, terms) / len(piece)
    if share >= COPY:
        return "copy", share
    own, here = np.unique(piece), np.unique(terms)
    there = lambda wanted, least: weight[np.intersect1d(wanted, here)].sum() >= least * weight[wanted].sum()
    return ("paraphrase" if share >= PARAPHRASE and there(own, PARAPHRASE) and there(answer, ANSWER) else None), share


def _search(docs: DataFrame, block: Block, rank: int, cosine: float) -> DataFrame:
    spark = docs.sparkSession
    path = work_path(spark, "hits")
    _hits(docs, block.terms).write.parquet(path)
    hits = spark.read.parquet(path)
    frequency = _frequencies(hits, len(block.terms))
    weight = np.log((docs.count() + 1) / (frequency + 1)) + 1e-3
    own = block.rows(weight)
    common = np.argsort(-frequency, kind="stable")[:COMMON]
    space = _latent_space(hits, own, weight, common, rank)
    pieces = own @ space
    pieces = (pieces / np.maximum(np.linalg.norm(pieces, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    matrix = (space * weight[:, None]).astype(np.float32)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("kind", pa.string()), ("share", pa.float64()), ("cosine", pa.float64()), ("first_word", pa.int64())])

    def near(latent: np.ndarray):
        for a in range(0, len(latent), 4096):
            part = latent[a:a + 4096]
            similar = part @ pieces.T / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-12)
            passage, piece = np.nonzero(similar >= cosine)
            yield from zip((passage + a).tolist(), piece.tolist(), similar[passage, piece].tolist())

    def run(batches):
        for batch in batches:
            rows = []
            for first, edges, places, terms, counts in _segments(batch):
                number, firsts = _block_numbers(edges, places, counts)
                latent = Rows(terms, number, firsts[-1], common).times(matrix)
                last = firsts[1:] - 1
                following = np.r_[latent[1:], np.zeros((1, latent.shape[1]), np.float32)]
                following[last[counts > 0]] = 0
                for passage, piece, similar in near(latent + following):
                    row = int(np.searchsorted(firsts, passage, "right")) - 1
                    a, b = np.searchsorted(number, [max(passage - 1, firsts[row]), min(passage + 3, firsts[row + 1])])
                    kind, share = _judge(block.pieces[piece], block.answers[piece], weight, terms[a:b], places[a:b])
                    if kind:
                        rows.append((first + row, int(block.items[piece]), kind, share, similar, int(passage - firsts[row]) * STRIDE))
            keep = pa.array([r[0] for r in rows], pa.int64())
            columns = [batch.column(0).take(keep), batch.column(1).take(keep), *(pa.array([r[i] for r in rows], schema[i + 1].type) for i in range(1, 6))]
            yield pa.record_batch(columns, schema=schema)

    return hits.mapInArrow(run, "doc_id long, text_hash long, item_id long, kind string, share double, cosine double, first_word long")


def matches(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, cosine: float = COSINE) -> DataFrame:
    """``doc_id, text_hash, item_id`` with the best ``kind, share, cosine`` and the passage it was found in."""
    found = [_search(docs, block, rank, cosine) for block in blocks(benchmark)]
    if not found:
        kinds = "doc_id long, text_hash long, item_id long, kind string, share double, cosine double, first_word long"
        return docs.sparkSession.createDataFrame([], kinds)
    together = found[0]
    for more in found[1:]:
        together = together.union(more)
    best = F.max_by(F.struct("kind", "share", "cosine", "first_word"), F.struct("share", "cosine", -F.col("first_word")))
    return together.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("best")).select("doc_id", "text_hash", "item_id", "best.*")


def clean(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that match no item."""
    found = matches(docs, benchmark, **settings).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    # by frame, as a column of documents may have any name
    same = docs["doc_id"].cast("long").eqNullSafe(found["_id"]) & (F.xxhash64(docs["text"]) == found["_hash"])
    return docs.join(found, same, "left_anti")
