"""Interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped for scoring.

Tokens are words and one end mark per document; the first word's context is a begin mark.  Every map task
adds up the bigrams of its documents and deals them, packed as arrays, into shards by a hash of the pair,
so that a very frequent word is spread over all shards.  A shard's task adds up what it was dealt and
writes a file of sorted 64-bit pair hashes and counts; what it knows of each word (occurrences, how many
continuations were seen once, twice, more often, and how many contexts the word follows) goes on to shards
by word, written likewise.  Workers map the files, so a lookup touches pages, not memory of its own.

The files lie under ``spark.checkpoint.dir``; as they are mapped, that folder has to be a mounted path.  A
task that is run again writes the same file and renames it into place.

Defined results: a null text is empty and holds the end mark alone; repeated rows count and are scored once
each; without training rows every token has probability one; a null ``doc_id`` stays null.  Other columns
are not read.
"""

from __future__ import annotations

import os
import shutil
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.texts import NOT_SPACE, binary, chunks, mixed, words
from feedloom.session import work_path

BEGIN, END = np.uint64(0xB0), np.uint64(0xE0)
SHARD_BYTES = 24 << 20  # of text for one shard
FLUSH_TOKENS = 3_000_000  # that a map task adds up before it deals them out
SCORE_TOKENS = 1_000_000  # that are looked up together, in order of their hashes
STATS = -1
_SUMMED = ("total", "once", "twice", "more", "contexts")


def _mounted(path: str) -> str:
    local = path.removeprefix("file://").removeprefix("file:")
    if "://" in local:
        raise ValueError(f"the model's files are memory-mapped: spark.checkpoint.dir has to be a mounted path, not {path}")
    return os.path.abspath(local)


def _tokens(chunk) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's tokens, each document's end mark included, and where each document begins."""
    found = words(chunk, NOT_SPACE)
    n = len(chunk)
    tokens = np.full(len(found.hash) + n, END)
    tokens[np.arange(len(found.hash)) + found.document()] = found.hash
    return tokens, found.first[:-1] + np.arange(n)


def _before(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    context = np.empty_like(tokens)
    context[1:] = tokens[:-1]
    context[starts] = BEGIN
    return context


def pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(context * np.uint64(0xC2B2AE3D27D4EB4F) + word)


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of the hash, so that sorting by hash sorts by shard."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row's place, the key and the sum of each distinct key, in order."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return order[first], keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts


def _deal(context: np.ndarray, word: np.ndarray, shards: int):
    """One row per shard: the bigrams, grouped by context, as one block of bytes."""
    row, keys, counts = _summed(pair_hash(context, word), np.ones(len(word), np.uint32))
    ends = np.searchsorted(_shard(keys, shards), np.arange(shards + 1))
    for shard in range(shards):
        part = slice(ends[shard], ends[shard + 1])
        if part.start == part.stop:
            continue
        by_context = np.argsort(context[row[part]])
        at = row[part][by_context]
        heads = np.flatnonzero(np.r_[True, np.diff(context[at]) != 0])
        sizes = np.array([len(at), len(heads)], np.int64)
        yield shard, b"".join(map(binary, (sizes, word[at], context[at[heads]], counts[part][by_context].astype(np.uint32), np.diff(np.r_[heads, len(at)]).astype(np.uint32))))


def _undeal(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, m = np.frombuffer(block, np.int64, 2)
    word = np.frombuffer(block, np.uint64, n, 16)
    context = np.frombuffer(block, np.uint64, m, 16 + 8 * n)
    counts = np.frombuffer(block, np.uint32, n, 16 + 8 * (n + m))
    runs = np.frombuffer(block, np.uint32, m, 16 + 12 * n + 8 * m)
    return np.repeat(context, runs), word, counts


def _write(folder: str, name: str, **columns: np.ndarray) -> None:
    for kind, column in columns.items():
        path = f"{folder}/{name}.{kind}"
        partial = f"{path}.{os.getpid()}.partial"
        column.tofile(partial)
        os.replace(partial, path)


def _rows(shards, blocks, names=("shard", "block")) -> pa.Table:
    return pa.table([pa.array(shards, pa.int32()), pa.array(blocks, pa.binary())], names=list(names))


def _counts_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.array([np.count_nonzero(counts == c) for c in (1, 2, 3, 4)], np.int64)


def _discounts(n: np.ndarray) -> np.ndarray:
    """For counts 0, 1, 2 and 3 or more; each between nothing and the count, also where a class is empty."""
    n = n.astype(float)
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    steps = [c - (c + 1) * y * n[c] / n[c - 1] if n[c - 1] else 0.0 for c in (1, 2, 3)]
    return np.array([0.0, *(min(max(d, 0.0), c) for c, d in zip((1, 2, 3), steps))])


@dataclass
class Model:
    folder: str
    shards: int
    tokens: int = 0  # of the training documents
    types: int = 0  # distinct, the end mark included
    pairs: int = 0  # distinct bigrams
    words: int = 0  # rows of the word files
    discounts: np.ndarray = field(default_factory=lambda: np.zeros(4))
    lower: np.ndarray = field(default_factory=lambda: np.zeros(4))  # discounts of the continuation counts
    left: float = 1.0  # what the lower order gives to the even distribution

    def drop(self) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)


def fit(train: DataFrame) -> Model:
    """Count the texts of ``train``.  The number of shards follows their bytes."""
    spark = train.sparkSession
    folder = _mounted(work_path(spark, "bigrams"))
    os.makedirs(folder, exist_ok=True)
    size = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-size // SHARD_BYTES) or 1

    def count(batches):
        contexts, tokens, held = [], [], 0

        def dealt():
            if tokens:
                found = list(_deal(np.concatenate(contexts), np.concatenate(tokens), shards))
                yield from _rows(*zip(*found)).to_batches()
            contexts.clear(), tokens.clear()

        for batch in batches:
            for chunk in chunks(batch.column(0)):
                own, starts = _tokens(chunk)
                tokens.append(own)
                contexts.append(_before(own, starts))
                held += len(own)
                if held >= FLUSH_TOKENS:
                    yield from dealt()
                    held = 0
        yield from dealt()

    def add_pairs(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        parts = [_undeal(block) for block in group["block"].to_pylist()]
        context, word, counts = (np.concatenate(x) for x in zip(*parts))
        row, keys, counts = _summed(pair_hash(context, word), counts.astype(np.uint64))
        context, word = context[row], word[row]
        _write(folder, f"pairs-{shard}", key=keys, count=np.minimum(counts, 0xFFFFFFFF).astype(np.uint32))
        stats = np.r_[_counts_of_counts(counts), np.int64(counts.sum()), len(counts)]
        ends = word == END
        of = np.concatenate([context, word, [END]])  # what each of these words is told to add
        none = np.zeros(len(word), np.uint64)
        added = [
            np.concatenate([counts, none, [counts[ends].sum(dtype=np.uint64)]]),
            *(np.concatenate([c.astype(np.uint64), none, [np.uint64(0)]]) for c in (counts == 1, counts == 2, counts > 2)),
            np.concatenate([none, none + np.uint64(1), [np.uint64(0)]]),
        ]
        order = np.argsort(of)
        of = of[order]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        of, added = of[first], [np.add.reduceat(a[order], first) for a in added]
        cuts = np.searchsorted(_shard(of, shards), np.arange(shards + 1))
        blocks = [b"".join(binary(x[cuts[s]:cuts[s + 1]]) for x in (of, *added)) for s in range(shards)]
        return _rows([STATS, *range(shards)], [binary(stats), *blocks])

    def add_words(group: pa.Table) -> pa.Table:
        shard, blocks = group["shard"][0].as_py(), group["block"].to_pylist()
        if shard == STATS:
            return _stats(sum(np.frombuffer(b, np.int64) for b in blocks), np.zeros(6, np.int64))
        parts = [np.frombuffer(b, np.uint64).reshape(1 + len(_SUMMED), -1) for b in blocks]
        told = np.concatenate(parts, axis=1)
        order = np.argsort(told[0])
        word = told[0][order]
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
        sums = np.add.reduceat(told[1:, order], first, axis=1) if len(word) else told[1:]
        _write(folder, f"words-{shard}", key=word[first], **dict(zip(_SUMMED, sums)))
        seen = sums[4]
        return _stats(np.zeros(6, np.int64), np.r_[_counts_of_counts(seen), np.count_nonzero(seen), len(first)])

    def _stats(pairs: np.ndarray, types: np.ndarray) -> pa.Table:
        return pa.table([pa.array([v], pa.int64()) for v in (*pairs, *types)], names=names)

    names = ["p1", "p2", "p3", "p4", "tokens", "pairs", "w1", "w2", "w3", "w4", "types", "words"]
    counted = train.select("text").mapInArrow(count, "shard int, block binary").groupBy("shard").applyInArrow(add_pairs, "shard int, block binary")
    told = counted.groupBy("shard").applyInArrow(add_words, ", ".join(f"{n} long" for n in names))
    total = told.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names)).first()
    lower = _discounts(np.array([total[f"w{c}"] for c in (1, 2, 3, 4)]))
    types, pairs = total["types"], total["pairs"]
    more = types - total["w1"] - total["w2"]
    left = (lower[1:] @ [total["w1"], total["w2"], more]) / pairs if pairs else 1.0
    discounts = _discounts(np.array([total[f"p{c}"] for c in (1, 2, 3, 4)]))
    return Model(folder, shards, total["tokens"], types, pairs, total["words"], discounts, lower, float(left))


class MissingFiles(RuntimeError):
    """A worker does not see all files of a model."""


class Maps:
    """The files of a model, mapped.  All rows that the fit has written have to be there."""

    def __init__(self, folder: str, shards: int, pairs: int, words: int) -> None:
        self.pairs = [self._open(folder, f"pairs-{s}", key=np.uint64, count=np.uint32) for s in range(shards)]
        self.words = [self._open(folder, f"words-{s}", key=np.uint64, **dict.fromkeys(_SUMMED, np.uint64)) for s in range(shards)]
        for kind, shards_, wanted in (("bigrams", self.pairs, pairs), ("words", self.words, words)):
            found = sum(len(s["key"]) for s in shards_ if s)
            if found != wanted or any(len(c) != len(s["key"]) for s in shards_ if s for c in s.values()):
                raise MissingFiles(f"{folder} holds {found} of {wanted} {kind} here; spark.checkpoint.dir has to be a folder that all executors share")

    @staticmethod
    def _open(folder: str, name: str, **kinds) -> dict[str, np.ndarray] | None:
        if not os.path.exists(f"{folder}/{name}.key") or not os.path.getsize(f"{folder}/{name}.key"):
            return None
        return {kind: np.memmap(f"{folder}/{name}.{kind}", dtype, "r") for kind, dtype in kinds.items()}

    @staticmethod
    def look_up(shards: list, keys: np.ndarray, columns: tuple[str, ...]) -> np.ndarray:
        """Columns of sorted distinct keys; nothing where a key is absent."""
        found = np.zeros((len(columns), len(keys)), np.uint64)
        cuts = np.searchsorted(_shard(keys, len(shards)), np.arange(len(shards) + 1))
        for shard, a, b in zip(shards, cuts[:-1], cuts[1:]):
            if shard is None or a == b:
                continue
            at = np.minimum(np.searchsorted(shard["key"], keys[a:b]), len(shard["key"]) - 1)
            there = shard["key"][at] == keys[a:b]
            for i, column in enumerate(columns):
                found[i, a:b] = np.where(there, shard[column][at], 0)
        return found


@lru_cache(maxsize=1)
def _maps(folder: str, shards: int, pairs: int, words: int) -> Maps:
    return Maps(folder, shards, pairs, words)


def _scored(model: Model, maps: Maps, tokens: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Of each document: tokens, known tokens, the base score and the model's log10 probability."""
    types, of = np.unique(np.r_[tokens, BEGIN], return_inverse=True)
    total, once, twice, more, seen = maps.look_up(maps.words, types, _SUMMED).astype(float)
    begin = types == BEGIN
    lower = np.maximum(seen - model.lower[np.minimum(seen, 3).astype(int)], 0) / max(model.pairs, 1) + model.left / (model.types + 1)
    given = np.where(types == END, 0, total)  # occurrences as a context
    back = np.divide(model.discounts[1] * once + model.discounts[2] * twice + model.discounts[3] * more, given, out=np.ones_like(given), where=given > 0)
    word, context = of[:-1], np.empty(len(tokens), np.int64)
    context[1:] = word[:-1]
    context[starts] = of[-1]
    keys, at = np.unique(pair_hash(types[context], tokens), return_inverse=True)
    count = maps.look_up(maps.pairs, keys, ("count",))[0].astype(float)
    kept = np.maximum(count - model.discounts[np.minimum(count, 3).astype(int)], 0)[at]
    chance = kept / np.maximum(given[context], 1) + back[context] * lower[word]
    known = np.where(begin, 0, total)[word]
    base = np.log10((known + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
    per = lambda x: np.add.reduceat(x, starts)  # noqa: E731  (every document holds its end mark)
    return [per(np.ones(len(tokens), np.int64)), per((known > 0).astype(np.int64)), per(base), per(np.log10(chance))]


def score(docs: DataFrame, model: Model, *columns: str | Column) -> DataFrame:
    """The columns asked for with ``n_tokens, n_known, train_tokens, base_score, score`` and the perplexity."""
    kept = docs.select(*columns)
    names = kept.columns

    def run(batches):
        maps = _maps(model.folder, model.shards, model.pairs, model.words)
        for batch in batches:
            held, first = [], 0
            count = 0
            for chunk in chunks(batch.column(batch.num_columns - 1)):
                held.append(_tokens(chunk))
                count += len(held[-1][0])
                if count >= SCORE_TOKENS or chunk.rows.stop == batch.num_rows:
                    tokens = np.concatenate([t for t, _ in held])
                    shifts = np.cumsum([0, *(len(t) for t, _ in held)])
                    starts = np.concatenate([s + shift for (_, s), shift in zip(held, shifts)])
                    n, known, base, own = _scored(model, maps, tokens, starts)
                    added = [n, known, np.full(len(n), model.tokens), base, own, 10 ** (-own / n)]
                    rows = batch.slice(first, chunk.rows.stop - first)
                    yield pa.record_batch([*rows.columns[:-1], *map(pa.array, added)], names=[*names, *new])
                    held, first, count = [], chunk.rows.stop, 0

    new = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    kinds = "n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), kinds])
    return docs.select(*columns, F.col("text").alias("_scored_text")).mapInArrow(run, schema)
