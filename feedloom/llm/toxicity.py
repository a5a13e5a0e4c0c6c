"""Toxic passages by maximum-scoring segments over token log-odds, calibrated by extreme values.

Fitting reads a bounded sample of labelled rows (``sample``, by hash of the id; one text of each), and nothing but their texts
and labels.  A token is a word; its stems, its first 4, 5 and 6 bytes, are scored alike, for languages that
inflect, and the word takes the largest score among them.  A score is the log-odds between toxic and clean texts under a Dirichlet prior
proportional to its frequency (``prior`` times as many pseudo-tokens as the sample has).  What is toxic
has log-odds that lie ``z`` standard errors above zero and reach a least value, the one of ``odds`` that gives the lowest log loss
when each half of the sample is scored by tokens learnt on the other half: weak log-odds help where little is known, and
mislead where toxic texts are more frequent in a language, whose words all have them.  Other words cost ``drift``.  A linear scan finds every maximal segment of a text.  For clean texts the
number of segments scoring s or more in n tokens is about K n exp(-lambda s); a passage is significant where
that is below one, and a text's evidence is the sum of -log of it over its significant passages.  A logistic
curve, fitted to the logarithm of evidence from scores learnt on the other half of the sample, turns evidence into the
probability of the label.

Defined results: null and empty texts have no passage and get the base rate's score; repeated rows are scored
once each; of repeated labels of a document the largest counts; null labels and ids teach nothing; without
usable labels all scores are the rate of the label, or 0.  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.texts import WORD, chunks, small_batches, words

SAMPLE = 32_768  # labelled rows read for fitting
Z = 3.0
ODDS = (0.0, 1.0, 2.0, 3.0)  # least log-odds of a scored token, one of which the fit chooses
PRIOR = 0.05
DRIFT = 0.1
HALVES = 2
STEMS = (4, 5, 6)
ALL = np.uint64(0)  # stands for any word: its counts are the totals


@dataclass
class Model:
    tokens: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted hashes
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0))
    drift: float = DRIFT
    rate: float = 1.0  # lambda
    size: float = 1.0  # K
    intercept: float = 0.0
    slope: float = 0.0


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a list of scores: start, end (exclusive) and sum, in linear time."""
    found: list[list] = []  # start, end, sum before it, sum up to its end
    total = 0.0
    for i in range(len(scores)):
        before, total = total, total + scores[i]
        if scores[i] <= 0:
            continue
        start, left, end, right = i, before, i + 1, total
        while True:
            at = len(found) - 1
            while at >= 0 and found[at][2] >= left:
                at -= 1
            if at < 0 or found[at][3] >= right:
                found.append([start, end, left, right])
                break
            start, left = found[at][0], found[at][2]
            del found[at:]
    return [(s, e, r - b) for s, e, b, r in found]


def _features(w) -> np.ndarray:
    """The word and its stems, a column of hashes for each word."""
    return np.stack([w.hash, *(w.prefix(size) for size in STEMS)])


def _found(features: np.ndarray, first: np.ndarray, model: Model) -> list[tuple[int, int, int, float]]:
    """Segments of each document of a chunk, as (document, first word, end word, score).

    Only scored tokens are walked through: between two of them lies a run of equal costs, taken as one.
    """
    if not len(model.tokens):
        return []
    value = np.zeros(features.shape[1])
    for hashes in features:
        at = np.minimum(np.searchsorted(model.tokens, hashes), len(model.tokens) - 1)
        hits = np.flatnonzero(model.tokens[at] == hashes)
        value[hits] = np.maximum(value[hits], model.scores[at[hits]])
    hits = np.flatnonzero(value)
    value = value[hits]
    document = np.searchsorted(first, hits, "right") - 1
    found = []
    for a, b in _runs(document):
        place, own = hits[a:b] - first[document[a]], value[a:b]
        items = np.empty(2 * (b - a) - 1)
        items[::2] = own
        items[1::2] = -model.drift * (np.diff(place) - 1)
        found += [(int(document[a]), int(place[s // 2]), int(place[(e - 1) // 2]) + 1, score) for s, e, score in segments(items)]
    return found


def _runs(keys: np.ndarray):
    if len(keys):
        edges = np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)]
        yield from zip(edges[:-1], edges[1:])


def _log_odds(toxic, clean, toxic_all, clean_all, prior):
    """Log-odds and their standard errors, with the prior shared out by overall frequency."""
    share = prior * (toxic + clean) / max(toxic_all + clean_all, 1)
    a, b = toxic + np.maximum(share, 1e-9), clean + np.maximum(share, 1e-9)
    odds = np.log(a / (toxic_all + prior - a)) - np.log(b / (clean_all + prior - b))
    return odds, np.sqrt(1 / a + 1 / b)


def _lambda(scores: np.ndarray, counts: np.ndarray, rest: float, drift: float) -> float:
    """Where the clean texts' mean of exp(lambda * score) is one."""
    total = counts.sum() + rest
    value = lambda x: (counts * np.exp(np.minimum(x * scores, 500))).sum() / total + rest / total * np.exp(-x * drift) - 1
    if not counts.sum() or value(1e-6) >= 0:
        return 1.0  # likelihood ratios have one by definition
    low, high = 1e-6, 1.0
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        low, high = ((low + high) / 2, high) if value((low + high) / 2) < 0 else (low, (low + high) / 2)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    design, w = np.stack([np.ones(len(x)), x], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (y - p) - 1e-3 * w)
        w += step
        if abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, z: float = Z, odds: tuple[float, ...] = ODDS, prior: float = PRIOR, drift: float = DRIFT) -> Model:
    """Learn from documents with ``labels (doc_id, toxic)``; rows to be held out are not to be among the labels."""
    small_batches(docs)
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    chosen = known.agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toArrow()
    if not chosen.num_rows:
        return Model(intercept=-30.0)
    taught = docs.sparkSession.createDataFrame(chosen).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(HALVES)).cast("int"))
    # at most ``sample`` rows of three integers, so the side sent to all executors is bounded
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(taught), "doc_id").select("doc_id", "toxic", "half", "text")
    # copies of a row teach as one; of several texts of an id, the first by hash does
    texts = texts.groupBy("doc_id").agg(F.min_by(F.struct("toxic", "half", "text"), F.xxhash64("text")).alias("r")).select("doc_id", "r.*")

    def count(batches):
        for batch in batches:
            classes = np.minimum(batch.column(1).to_numpy(), 1) + 2 * batch.column(2).to_numpy()
            held = []
            for c in chunks(batch.column(3)):
                w = words(c, WORD)
                kinds = np.repeat(classes[c.rows], np.diff(w.first))
                features = np.concatenate([np.full((1, len(kinds)), ALL), _features(w)])
                present = features != 0
                present[0] = True
                held.append((features[present], np.broadcast_to(kinds, features.shape)[present]))
            hashes, kinds = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            tokens, at = np.unique(hashes, return_inverse=True)
            counts = np.bincount(at * 4 + kinds, minlength=4 * len(tokens)).reshape(-1, 4)
            yield pa.record_batch([pa.array(tokens.view(np.int64)), *(pa.array(c) for c in counts.T.astype(np.int64))], names=["token", *names])

    names = ["clean0", "toxic0", "clean1", "toxic1"]
    sums = [F.sum(n).alias(n) for n in names]
    counted = texts.mapInArrow(count, "token long, " + ", ".join(f"{n} long" for n in names)).groupBy("token").agg(*sums)
    totals = list((counted.where(F.col("token") == int(ALL)).drop("token").first() or [0] * 4))
    prior = max(prior * sum(totals), 1.0)
    both = F.col("toxic0") + F.col("toxic1")
    share = F.lit(prior) * (both + F.col("clean0") + F.col("clean1")) / F.lit(max(sum(totals), 1))
    clean = F.col("clean0") + F.col("clean1")
    rough = F.log((both + share) / (totals[1] + totals[3] + prior)) - F.log((clean + share) / (totals[0] + totals[2] + prior))
    error = F.sqrt(1 / (both + share) + 1 / (clean + share))
    # a token that misses the bar over all, by far, reaches it in neither half; as the sample is bounded, so are its tokens
    kept = counted.where((F.col("token") != int(ALL)) & (both > 0)).withColumn("z", rough / error).where((F.col("z") > z / 2) & (rough > min(odds) / 2)).toArrow()
    token = kept["token"].to_numpy().view(np.uint64)
    order = np.argsort(token)
    token = token[order]
    c0, t0, c1, t1 = (kept[n].to_numpy()[order].astype(float) for n in names)

    def scored(toxic, clean, toxic_all, clean_all, least) -> Model:
        own, error = _log_odds(toxic, clean, toxic_all, clean_all, prior)
        good = (own > z * error) & (own >= least)
        model = Model(token[good], own[good], drift)
        counts = clean[good]
        model.rate = _lambda(model.scores, counts, max(clean_all - counts.sum(), 1.0), drift)
        return model

    # for each least value and half, from the other half
    by_other = [[scored(t1, c1, totals[3], totals[2], least), scored(t0, c0, totals[1], totals[0], least)] for least in odds]

    def seen(batches):
        for batch in batches:
            toxic, half = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            rows = []
            for c in chunks(batch.column(3)):
                w = words(c, WORD)
                lengths, features = np.diff(w.first), _features(w)
                per: dict[tuple[int, int], list[float]] = {}
                for choice, models in enumerate(by_other):
                    for h, model in enumerate(models):
                        for document, _, _, score in _found(features, w.first, model):
                            if half[c.rows.start + document] == h:
                                per.setdefault((document, choice), []).append(score)
                rows += [(int(min(toxic[c.rows.start + d], 1)), int(half[c.rows.start + d]), int(lengths[d]), [per.get((d, choice), []) for choice in range(len(odds))]) for d in range(len(c))]
            yield pa.RecordBatch.from_pylist([dict(zip(("toxic", "half", "n", "scores"), r)) for r in rows], schema=seen_schema)

    seen_schema = pa.schema([("toxic", pa.int32()), ("half", pa.int32()), ("n", pa.int64()), ("scores", pa.list_(pa.list_(pa.float64())))])
    rows = texts.mapInArrow(seen, "toxic int, half int, n long, scores array<array<double>>").toArrow().to_pylist()
    if not rows:
        return Model(intercept=-30.0)
    y = np.array([r["toxic"] for r in rows], float)
    best = None
    for choice, least in enumerate(odds):
        final = scored(t0 + t1, c0 + c1, totals[1] + totals[3], totals[0] + totals[2], least)
        for half, model in [*enumerate(by_other[choice]), (None, final)]:
            clean = [r for r in rows if not r["toxic"] and half in (None, r["half"])]
            found = [s for r in clean for s in r["scores"][choice]]
            model.size = max(len(found), 1) / max(sum(r["n"] for r in clean) * np.exp(-model.rate * min(found, default=0.0)), 1e-300)
        x = np.log1p([_evidence(r["scores"][choice], r["n"], by_other[choice][r["half"]]) for r in rows])
        final.intercept, final.slope = _logistic(x, y)
        loss = np.logaddexp(0, (1 - 2 * y) * np.clip(final.intercept + final.slope * x, -30, 30)).mean()
        if best is None or loss <= best[0]:  # of equal losses, the larger least value
            best = loss, final
    return best[1]


def _evidence(scores: list[float], n: int, model: Model) -> float:
    """Sum of -log of the number of such segments expected in n clean tokens, where below one."""
    return sum(max(0.0, model.rate * s - np.log(model.size * max(n, 1))) for s in scores)


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, first_word, end_word, score, expected``: each significant passage, words counted from 0."""

    def find(batches):
        for batch in batches:
            rows = []
            for c in chunks(batch.column(1)):
                w = words(c, WORD)
                for document, start, end, score in _found(_features(w), w.first, model):
                    n = int(w.first[document + 1] - w.first[document])
                    expected = float(model.size * n * np.exp(-model.rate * score))
                    if expected < 1:
                        rows.append((batch.column(0)[c.rows.start + document].as_py(), start, end, score, expected))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, "doc_id long, first_word long, end_word long, score double, expected double")


def score(docs: DataFrame, model: Model, *columns: str | Column) -> DataFrame:
    """The columns asked for with ``score`` (probability of the label), ``n_passages`` and ``evidence``."""
    return _scored(docs, model, columns, keep_text=False)


def _scored(docs: DataFrame, model: Model, columns, keep_text: bool) -> DataFrame:
    """``score``; with ``keep_text`` the text comes back as ``_scored_text``, having been sent once."""
    small_batches(docs)
    text = F.col("text").alias("_scored_text")
    kept = docs.select(*columns, *[text] * keep_text)
    names = kept.columns

    def run(batches):
        for batch in batches:
            evidence, number = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for c in chunks(batch.column(batch.num_columns - 1)):
                w = words(c, WORD)
                for document, _, _, s in _found(_features(w), w.first, model):
                    own = _evidence([s], int(w.first[document + 1] - w.first[document]), model)
                    evidence[c.rows.start + document] += own
                    number[c.rows.start + document] += own > 0
            chance = 1 / (1 + np.exp(-np.clip(model.intercept + model.slope * np.log1p(evidence), -30, 30)))
            yield pa.record_batch([*batch.columns[:len(names)], pa.array(chance), pa.array(number), pa.array(evidence)], names=[*names, "score", "n_passages", "evidence"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "score double, n_passages long, evidence double"])
    return docs.select(*columns, text).mapInArrow(run, schema)


def reject(docs: DataFrame, model: Model, at: float) -> DataFrame:
    """The rows of ``docs`` that score below ``at``, as they are."""
    others = [c for c in docs.columns if c != "text"]
    rows = _scored(docs, model, [F.struct(*others).alias("_row")], keep_text=True).where(F.col("score") < at)
    return rows.select(*(F.col("_scored_text").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns))
