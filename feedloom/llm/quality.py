"""Document quality by co-training a classifier of the content and one of the metadata.

The content view is the mix of byte trigrams of the text (hashed to ``GRAMS``, square roots of their shares);
the metadata view is language, source, length and layout (lines, letters, digits, punctuation).  Both start
from the same labelled rows.  In every round each classifier scores all other documents and hands
those it is surest of, in the proportion of the classes, to the other one; then both are fitted anew.  Each view is
calibrated on labelled rows that neither was fitted on, and so is their combination, which scores all rows.

The labelled rows are a bounded sample (``sample``, by hash of the id).  All documents outside it take part without a label:
their views are written once, as bytes, to the shared folder and read in every round.  A view teaches ``share`` times
as many rows a round as there are labelled ones, so what the driver fits is bounded too.  Equal views, such as
those of copies, are one row; a row is taught as the class that its teacher takes it for, and once to each view.

Defined results: null and empty texts have no trigrams and are scored by the metadata; null languages and
sources are a class of their own; a null ``n_chars`` is the text's length; of repeated labels the largest
counts; null labels and ids teach nothing; without labels of both classes all scores are the labels' share,
or 0.5.  Repeated rows are scored once each; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.texts import Chunk, chunks, mixed, small_batches, table, word_hash
from feedloom.session import work_path

SAMPLE = 8192
GRAMS = 1024
NAMES = 64  # classes that languages and sources are hashed to, each
ROUNDS = 4
SHARE = 0.04  # rows that a view teaches in a round, of the number of labelled ones
CALIBRATION = 4  # one in so many labelled rows is kept for calibration
RIDGE = 1.0
_KINDS = (table((0x41, 0x5A)), table((0x61, 0x7A)), table((0x30, 0x39)), table((0x20, 0x20)), table((0x0A, 0x0A)), table((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)), table((0x80, 0xFF)), table((0x7C, 0x7C)), table((0x21, 0x21)), table((0x2E, 0x2E)))
INPUTS = ("lang", "source", "n_chars", "text")


def content(chunk: Chunk) -> np.ndarray:
    """Counts of hashed byte trigrams, a row for each document."""
    data = chunk.data.astype(np.uint64)
    text = np.repeat(np.arange(len(chunk)), np.diff(chunk.offsets))
    if len(data) < 3:
        return np.zeros((len(chunk), GRAMS), np.uint32)
    gram = (data[:-2] << np.uint64(16)) | (data[1:-1] << np.uint64(8)) | data[2:]
    at = ((gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAMS.bit_length() + 1)).astype(np.int64)
    inside = text[2:] == text[:-2]
    return np.bincount(text[:-2][inside] * GRAMS + at[inside], minlength=len(chunk) * GRAMS).reshape(-1, GRAMS).astype(np.uint32)


def _shares(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)).astype(np.float32)


def metadata(chunk: Chunk, lang: list, source: list, n_chars: list) -> np.ndarray:
    """Language and source as hashed classes, length and layout, a row for each document."""
    lengths = np.diff(chunk.offsets)
    kinds = np.stack([np.diff(np.r_[0, np.cumsum(inside[chunk.data])][chunk.offsets]) for inside in _KINDS], 1)
    share = kinds / np.maximum(lengths, 1)[:, None]
    said = np.array([length if n is None else n for n, length in zip(n_chars, lengths)], float)
    lines = kinds[:, 4] + 1
    layout = np.c_[np.log1p(np.maximum(said, 0)), np.log1p(lines), np.log1p(lengths / lines), share, np.sqrt(share)]
    classes = np.zeros((len(chunk), 2 * NAMES))
    for k, names in enumerate((lang, source)):
        classes[np.arange(len(chunk)), k * NAMES + np.array([word_hash(f"{k}:{n}") % NAMES for n in names], np.int64)] = 1
    return np.c_[layout, classes].astype(np.float32)


@dataclass
class View:
    """A logistic classifier over standardised columns."""

    centre: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> View:
        centre, scale = x.mean(0), x.std(0)
        scale = np.where(scale > 1e-6, scale, np.inf)
        design = np.c_[(x - centre) / scale, np.ones(len(x), np.float32)].astype(np.float32)
        w = np.zeros(design.shape[1])
        penalty = np.full(len(w), ridge * np.sqrt(len(w)))
        penalty[-1] = 1e-6
        for _ in range(12):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            hessian = ((design * (p * (1 - p) + 1e-6)[:, None].astype(np.float32)).T @ design).astype(float) + np.diag(penalty)
            step = np.linalg.solve(hessian, design.T @ (y - p) - penalty * w)
            w += step
            if abs(step).max() < 1e-4:
                break
        return cls(centre, scale, w[:-1], float(w[-1]))

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.centre) / self.scale) @ self.weight + self.bias, -30, 30)


@dataclass
class Model:
    content: View | None
    metadata: View | None
    join: np.ndarray  # of calibrated content logit, calibrated metadata logit, one
    calibration: np.ndarray  # a row for each view: slope and intercept

    def score(self, grams: np.ndarray, other: np.ndarray) -> np.ndarray:
        if self.content is None or self.metadata is None:
            return np.full(len(grams), 1 / (1 + np.exp(-self.join[2])))
        logits = [view.logits(x) * a + b for view, x, (a, b) in zip((self.content, self.metadata), (_shares(grams), other), self.calibration)]
        return 1 / (1 + np.exp(-np.clip(logits[0] * self.join[0] + logits[1] * self.join[1] + self.join[2], -30, 30)))


def _line(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression on a few columns, as they are: their weights and the intercept."""
    design, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hessian, design.T @ (y - p) - 1e-2 * w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return w


def _unpacked(rows) -> tuple[np.ndarray, np.ndarray]:
    """Both views of rows with ``grams`` and ``other``."""
    n = len(rows["grams"])
    bytes_, other = (np.frombuffer(b"".join(rows[c].to_pylist()), t).reshape(n, -1) for c, t in (("grams", np.uint8), ("other", np.float32)))
    grams = bytes_.astype(np.float32)
    return grams / np.maximum(np.sqrt((grams * grams).sum(1, keepdims=True)), 1), other


class Pool:
    """The views of all documents but those in ``labelled``, as a table; null ids are left out.

    Trigrams are kept as bytes: square roots of their counts, of the largest one's.
    """

    def __init__(self, docs: DataFrame, labelled: DataFrame) -> None:
        self.spark = docs.sparkSession

        def run(batches):
            for batch in batches:
                for c, grams, other in _views(batch, 1):
                    packed = np.rint(255 * np.sqrt(grams / np.maximum(grams.max(1, keepdims=True), 1))).astype(np.uint8)
                    ids = batch.column(0).slice(c.rows.start, len(c))
                    yield pa.record_batch([ids, *(pa.array([r.tobytes() for r in x], pa.binary()) for x in (packed, other))], names=["doc_id", "grams", "other"])

        read = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), *INPUTS)
        views = small_batches(read).mapInArrow(run, "doc_id long, grams binary, other binary")
        path = work_path(self.spark, "views")
        views.join(labelled, "doc_id", "left_anti").select(F.xxhash64("grams", "other").alias("key"), "grams", "other").write.parquet(path)
        self.table = self.spark.read.parquet(path)

    def surest(self, views: list[View], counts: tuple[int, int], taught: list[np.ndarray]) -> pa.Table:
        """``view, label, key, grams, other``: what each view is surest of, ``counts`` rows of the two classes, and the
        other view has not been taught."""

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys, first = np.unique(batch.column(0).to_numpy(), return_index=True)
                both = _unpacked(pa.table([c.take(pa.array(first)) for c in batch.columns], names=batch.schema.names))
                for me, other in ((0, 1), (1, 0)):
                    logits = views[me].logits(both[me])
                    fresh = ~np.isin(keys, taught[other])
                    for label, sure in enumerate((-logits, logits)):
                        at = np.flatnonzero(fresh & (sure > 0))
                        at = at[np.lexsort((keys[at], -sure[at]))[:counts[label]]]
                        yield pa.record_batch([pa.array(np.full(len(at), v), pa.int32()) for v in (me, label)] + [pa.array(keys[at]), pa.array(sure[at].astype(float))], names=["view", "label", "key", "sure"])

        said = self.table.mapInArrow(run, "view int, label int, key long, sure double").groupBy("view", "label", "key").agg(F.max("sure").alias("sure"))
        place = F.row_number().over(Window.partitionBy("view", "label").orderBy(F.desc("sure"), "key"))
        wanted = F.when(F.col("label") == 1, counts[1]).otherwise(counts[0])
        picked = said.withColumn("place", place).where(F.col("place") <= max(counts)).where(F.col("place") <= wanted).select("view", "label", "key")
        # two views' rows of three integers, ``counts`` of each: the side sent to all executors is bounded
        picked = picked.toArrow().sort_by([("view", "ascending"), ("label", "ascending"), ("key", "ascending")])
        keys = self.spark.createDataFrame(picked.select(["key"])).distinct()
        rows = self.table.join(F.broadcast(keys), "key").groupBy("key").agg(F.first("grams").alias("grams"), F.first("other").alias("other"))
        rows = {r["key"]: r for r in rows.toArrow().to_pylist()}
        for name in ("grams", "other"):
            picked = picked.append_column(name, pa.array([rows[k][name] for k in picked["key"].to_pylist()], pa.binary()))
        return picked


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: Pool, rounds: int = ROUNDS, share: float = SHARE) -> list[View]:
    """Both views, fitted after they have exchanged pseudo-labels of the pool."""
    given = [(x, y) for x in views]
    taught = [np.zeros(0, np.int64), np.zeros(0, np.int64)]  # keys that a view has been taught
    fitted = [View.fit(x, t) for x, t in given]
    count = int(np.ceil(share * len(y)))
    ones = int(round(count * y.mean()))
    for _ in range(rounds):
        rows = pool.surest(fitted, (count - ones, ones), taught)
        if not rows.num_rows:
            break
        teacher, label, key = (rows[c].to_numpy() for c in ("view", "label", "key"))
        both = _unpacked(rows)
        for me, other in ((0, 1), (1, 0)):
            own, (x, t) = teacher == me, given[other]
            given[other] = np.concatenate([x, both[other][own]]), np.r_[t, label[own]]
            taught[other] = np.r_[taught[other], key[own]]
        fitted = [View.fit(x, t) for x, t in given]
    return fitted


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS, share: float = SHARE) -> Model:
    """Learn from a sample of the documents with ``labels (doc_id, quality)`` and, without a label, from all others."""
    small_batches(docs)
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # ``sample`` rows of two integers: the side sent to all executors is bounded
    picked = docs.sparkSession.createDataFrame(chosen.toArrow())
    read = docs.select(F.col("doc_id").cast("long"), *INPUTS).join(F.broadcast(picked), "doc_id").select("doc_id", "label", *INPUTS)
    # copies of a row teach as one; a repeated id with several texts teaches the one that comes first by hash
    read = read.withColumn("at", F.xxhash64(*INPUTS)).groupBy("doc_id").agg(F.min_by(F.struct("label", *INPUTS), "at").alias("r")).select("doc_id", "r.*")

    def run(batches):
        for batch in batches:
            for c, grams, other in _views(batch, 2):
                rows = batch.slice(c.rows.start, len(c))
                yield pa.record_batch([rows.column(0), rows.column(1), *(pa.array([r.tobytes() for r in x], pa.binary()) for x in (np.minimum(grams, 65535).astype(np.uint16), other))], names=["doc_id", "label", "grams", "other"])

    rows = read.mapInArrow(run, "doc_id long, label int, grams binary, other binary").toArrow().sort_by("doc_id")
    y = np.minimum(rows["label"].to_numpy().astype(float), 1)
    if not len(y) or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 0.5
        bounded = min(max(rate, 1e-6), 1 - 1e-6)
        return Model(None, None, np.array([0, 0, np.log(bounded / (1 - bounded))]), np.zeros((2, 2)))
    own = [np.frombuffer(b"".join(rows[c].to_pylist()), t).reshape(rows.num_rows, -1) for c, t in (("grams", np.uint16), ("other", np.float32))]
    own = (_shares(own[0]), own[1])
    apart = mixed(rows["doc_id"].to_numpy().view(np.uint64)) % np.uint64(CALIBRATION) == 0
    if len(y) < 4 * CALIBRATION or y[apart].min(initial=1) == y[apart].max(initial=0) or y[~apart].min(initial=1) == y[~apart].max(initial=0):
        apart = np.zeros(len(y), bool)  # too few to keep any back
    pool = Pool(docs, F.broadcast(picked.select("doc_id")))
    fitted = co_train(tuple(x[~apart] for x in own), y[~apart], pool, rounds, share)
    held = apart if apart.any() else ~apart
    logits = [view.logits(x[held]) for view, x in zip(fitted, own)]
    calibration = np.array([_line(z[:, None], y[held]) for z in logits])
    joined = _line(np.stack([z * a + b for z, (a, b) in zip(logits, calibration)], 1), y[held])
    return Model(*fitted, joined, calibration)


def _views(batch: pa.RecordBatch, first: int):
    """Both views of each chunk of a batch whose columns from ``first`` on are the inputs."""
    lang, source, n_chars = (batch.column(first + i).to_pylist() for i in range(3))
    for c in chunks(batch.column(first + 3)):
        yield c, content(c), metadata(c, lang[c.rows], source[c.rows], n_chars[c.rows])


def score(docs: DataFrame, model: Model, *columns: str | Column) -> DataFrame:
    """The columns asked for with ``score``, the probability of good quality."""
    small_batches(docs)
    kept = docs.select(*columns)
    names = kept.columns

    def run(batches):
        for batch in batches:
            found = [model.score(grams, other) for _, grams, other in _views(batch, len(names))]
            yield pa.record_batch([*batch.columns[:len(names)], pa.array(np.concatenate(found) if found else np.zeros(0))], names=[*names, "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "score double"])
    return docs.select(*columns, *(F.col(c).alias(f"_{c}") for c in INPUTS)).mapInArrow(run, schema)
