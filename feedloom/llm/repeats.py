"""Removal of passages that an earlier document holds, by sorting substrings where documents may meet.

A document is a string of bytes.  A byte goes if it is covered by a ``length``-byte string that also starts in
a document with a smaller id; strings are judged on the input.

Equal strings can only be found where they meet, and to send every string somewhere would move the corpus
fifty times over.  So each string is named by the least hash among the ``gram``-byte grams inside it: equal
strings have equal names, and consecutive strings mostly share one.  A run of strings of one name is sent to
the shard of the name only if the name occurs in two texts.  There all its strings are sorted
(``suffix_sort``), and equal ones are told apart by document.  Names route, bytes decide.  A name of more than
``hot`` strings (a phrase in many documents, with other bytes around it in each) would fill a shard: its strings
travel one by one to the shards of their own hashes, where equal ones still meet.

Texts equal as a whole are one text with the least of their ids; of equal runs in one chunk of documents only
that of the least document travels.  The chunks, of about ``chunk_bytes``, are shuffled once and the other
steps read that shuffle again.

Defined results: a null text is empty; texts below ``length`` bytes lose nothing; rows without an id count as
after all others and not before one another; repeated rows have the same result each; an empty table gives no
rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.suffix_sort import deep_shallow
from feedloom.llm.texts import binary, mixed, small_batches

LENGTH = 50
GRAM = 16
CHUNK_BYTES = 1 << 20
NAME_SHARD = 24 << 20  # bytes of text per shard of names
SORT_SHARD = 3 << 20  # bytes of text per shard of runs
HOT = 1 << 16  # strings of one name that travel as runs
LAST = (1 << 63) - 1  # stands for no id
_BASE = 0x9E3779B97F4A7C15


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on, by doubling."""
    step = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    width, done, total = 1, 0, None
    while size:
        if size & 1:
            if total is None:
                total = step
            else:
                n = len(step) - done
                total = total[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + step[done:]
            done += width
        size >>= 1
        if size:
            n = len(step) - width
            step = step[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + step[width:]
            width *= 2
    return mixed(total)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of the ``width`` values from each place on, by doubling."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:len(values) - (width - done)], values[width - done:]) if done < width else values


def runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with one name: name, text, first and how many."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none
    names = mixed(_least(_grams(data, gram), length - gram + 1))  # least values lie near zero: spread them again
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = text[:len(names)] == text[length - 1:]
    new = inside.copy()
    new[1:] &= (names[1:] != names[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new)
    last = np.flatnonzero(inside & np.r_[new[1:] | ~inside[1:], True])
    return names[first], text[first], first, last - first + 1


def _shard(names: np.ndarray, shards: int) -> np.ndarray:
    return ((names >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class _Texts:
    """The distinct texts of a chunk, in order of their digests, each with its least id."""

    def __init__(self, group: pa.Table) -> None:
        held: dict[bytes, list] = {}
        for digest, doc_id, text in zip(*(group[c].to_pylist() for c in ("digest", "doc_id", "text"))):
            own = held.setdefault(digest, [LAST, None])
            own[0] = min(own[0], LAST if doc_id is None else doc_id)
            own[1] = own[1] if text is None else text.encode()
        self.digests = sorted(held)
        self.ids = np.array([held[d][0] for d in self.digests], np.int64)
        self.texts = [held[d][1] for d in self.digests]
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        self.offsets = np.r_[0, np.cumsum([len(t) for t in self.texts])].astype(np.int64)


def _pack(*columns: np.ndarray) -> bytes:
    return np.int64(len(columns[0])).tobytes() + b"".join(map(binary, columns))


def _unpack(block: bytes, *kinds) -> list[np.ndarray]:
    n, at, found = int(np.frombuffer(block, np.int64, 1)[0]), 8, []
    for kind in kinds:
        found.append(np.frombuffer(block, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return [*found, at]


def _joined(blocks, *kinds) -> list[np.ndarray]:
    parts = [_unpack(b, *kinds)[:-1] for b in blocks]
    return [np.concatenate(x) if x else np.zeros(0, k) for k, x in zip(kinds, [*zip(*parts)] or [()] * len(kinds))]


_RUN = (np.uint32, np.int64, np.uint32, np.uint32)  # text, id, first string, strings
_SPAN = (np.uint32, np.uint32, np.uint32)  # text, start, end


def _spans_of(record: np.ndarray, place: np.ndarray, text: np.ndarray, first: np.ndarray, length: int):
    """Maximal runs of covered strings: record and place of each, in order, as text, start and end."""
    edges = np.flatnonzero(np.r_[True, (record[1:] != record[:-1]) | (place[1:] != place[:-1] + 1), True]) if len(record) else np.zeros(1, np.int64)
    a, b = edges[:-1], edges[1:] - 1
    return record[a], text[record[a]], first[record[a]] + place[a], first[record[a]] + place[b] + length


def _cut(data: np.ndarray, names: np.ndarray, text: np.ndarray, first: np.ndarray, many: np.ndarray, cut: np.ndarray, length: int):
    """Runs, of which those marked are cut into single strings that are named by all their bytes."""
    one = many[cut]
    place = np.repeat(first[cut] - np.r_[0, np.cumsum(one)[:-1]], one) + np.arange(one.sum())
    single = (_grams(data, length)[place], np.repeat(text[cut], one), place, np.ones(len(place), np.int64))
    return [np.r_[x[~cut], y] for x, y in zip((names, text, first, many), single)]


def _routes(texts: _Texts, shared: np.ndarray, hot: np.ndarray, length: int, gram: int, shards: int, chunk: int):
    """What a chunk sends: its shared runs to their shards, and to itself the spans that it can tell alone.

    ``hot`` marks the ``shared`` names whose runs are cut into single strings.
    """
    names, text, first, many = runs(texts.data, texts.offsets, length, gram)
    if len(shared) and len(names):
        at = np.minimum(np.searchsorted(shared, names), len(shared) - 1)
        kept = np.flatnonzero(shared[at] == names)
        cut = hot[at[kept]] > 0
        names, text, first, many = names[kept], text[kept], first[kept], many[kept]
        if cut.any():
            names, text, first, many = _cut(texts.data, names, text, first, many, cut, length)
    else:
        names, text, first, many = names[:0], text[:0], first[:0], many[:0]
    ids, raw, own = texts.ids[text], texts.data.tobytes(), first - texts.offsets[text]
    least: dict[bytes, int] = {}
    strings = [raw[f:f + m + length - 1] for f, m in zip(first.tolist(), many.tolist())]
    for string, doc_id in zip(strings, ids.tolist()):
        if doc_id < least.get(string, LAST + 1):
            least[string] = doc_id
    later = np.array([least[s] < i for s, i in zip(strings, ids.tolist())], bool)
    if later.any():
        yield -1 - chunk, chunk, _pack(text[later].astype(np.uint32), own[later].astype(np.uint32), (own + many + length - 1)[later].astype(np.uint32))
    here = np.flatnonzero(~later)
    here = here[np.argsort(names[here], kind="stable")]
    cuts = np.searchsorted(_shard(names[here], shards), np.arange(shards + 1))
    for shard in range(shards):
        part = here[cuts[shard]:cuts[shard + 1]]
        if len(part):
            yield shard, chunk, _pack(text[part].astype(np.uint32), ids[part], own[part].astype(np.uint32), many[part].astype(np.uint32)) + b"".join(strings[i] for i in part)


def _sorted_spans(chunks: list[int], blocks: list[bytes], length: int):
    """Spans per chunk: of the strings of the runs, those that a smaller id has too."""
    text, ids, first, many, chunk, raw = [], [], [], [], [], []
    for c, block in zip(chunks, blocks):
        t, i, f, m, at = _unpack(block, *_RUN)
        text.append(t), ids.append(i), first.append(f), many.append(m), raw.append(block[at:])
        chunk.append(np.full(len(t), c))
    text, ids, first, many, chunk = (np.concatenate(x) for x in (text, ids, first, many, chunk))
    text, first, many = text.astype(np.int64), first.astype(np.int64), many.astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    begins = np.r_[0, np.cumsum(many + length - 1)][:-1]
    record = np.repeat(np.arange(len(many)), many)
    place = np.arange(len(record)) - np.repeat(np.r_[0, np.cumsum(many)][:-1], many)
    order, new = deep_shallow(data, begins[record] + place, length)
    heads = np.flatnonzero(new)
    own = ids[record[order]]
    least = np.repeat(np.minimum.reduceat(own, heads), np.diff(np.r_[heads, len(own)]))
    covered = np.sort(order[own > least])  # back in order of records and places
    at, t, a, b = _spans_of(record[covered], place[covered], text, first, length)
    by = np.argsort(chunk[at], kind="stable")
    edges = np.flatnonzero(np.r_[True, np.diff(chunk[at][by]) != 0, True]) if len(by) else np.zeros(1, np.int64)
    for x, y in zip(edges[:-1], edges[1:]):
        rows = by[x:y]
        yield int(chunk[at[rows[0]]]), _pack(*(c[rows].astype(np.uint32) for c in (t, a, b)))


def _table(rows, schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Removal that leaves UTF-8: a character goes if all its bytes do."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(heads):
        return gone
    return np.repeat(np.minimum.reduceat(gone, heads), np.diff(np.r_[heads, len(data)]))


def by_text(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, chunk_bytes: int = CHUNK_BYTES, keep_text: bool = False, hot: int = HOT) -> DataFrame:
    """For each distinct text, by ``digest`` (SHA-256): ``first_id, n_bytes, n_removed, n_spans, kept_sha256``.

    The results are those of the document ``first_id``; ``kept`` on demand has what is left of it as text,
    in which a character goes only if all its bytes do.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, names, sorts = (-(-size // part) or 1 for part in (chunk_bytes, NAME_SHARD, SORT_SHARD))

    def distinct(batches):
        seen: dict[bytes, int] = {}
        for batch in batches:
            rows = []
            for chunk, digest, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                rank = LAST if doc_id is None else doc_id
                if digest not in seen or rank < seen[digest]:
                    rows.append((chunk, digest, doc_id, None if digest in seen else text))
                    seen[digest] = rank
            yield from _table(rows, texts_schema).to_batches()

    def find_names(group: pa.Table) -> pa.Table:
        chunk, texts = group["chunk"][0].as_py(), _Texts(group)
        found, text, _, many = runs(texts.data, texts.offsets, length, gram)
        order = np.argsort(found, kind="stable")
        found, text, many = found[order], text[order], many[order]
        heads = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, np.int64)
        several = np.zeros(0, np.uint8)
        if len(heads):
            # one byte: whether there are several texts, and the power of two that the strings don't exceed
            several = (np.minimum.reduceat(text, heads) != np.maximum.reduceat(text, heads)).astype(np.uint8)
            several += 2 * np.ceil(np.log2(np.add.reduceat(many, heads))).astype(np.uint8)
        found = found[heads]
        cuts = np.searchsorted(_shard(found, names), np.arange(names + 1))
        return _table([(s, chunk, _pack(found[a:b], several[a:b])) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a], block_schema)

    def share_names(group: pa.Table) -> pa.Table:
        blocks = [_unpack(b, np.uint64, np.uint8) for b in group["block"].to_pylist()]
        name, several = (np.concatenate([b[i] for b in blocks]) for i in (0, 1))
        chunk = np.repeat(group["chunk"].to_numpy(), [len(b[0]) for b in blocks])
        order = np.argsort(name, kind="stable")
        name, several, chunk = name[order], several[order], chunk[order]
        heads = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
        sizes = np.diff(np.r_[heads, len(name)])
        shared = np.repeat((sizes > 1) | (np.maximum.reduceat(several & 1, heads) > 0), sizes)
        large = np.repeat(np.add.reduceat(np.int64(1) << (several >> 1).astype(np.int64), heads) > hot, sizes).astype(np.uint8)
        name, chunk, large = name[shared], chunk[shared], large[shared]
        by = np.argsort(chunk, kind="stable")
        name, chunk, large = name[by], chunk[by], large[by]
        edges = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1], True]) if len(name) else np.zeros(1, np.int64)
        return _table([(0, int(chunk[a]), _pack(name[a:b], large[a:b])) for a, b in zip(edges[:-1], edges[1:])], block_schema)

    def route(group: pa.Table, found: pa.Table) -> pa.Table:
        if not group.num_rows or not found.num_rows:
            return _table([], block_schema)
        shared, large = _joined(found["block"].to_pylist(), np.uint64, np.uint8)
        order = np.argsort(shared, kind="stable")
        return _table(_routes(_Texts(group), shared[order], large[order], length, gram, sorts, group["chunk"][0].as_py()), block_schema)

    def sort_runs(group: pa.Table) -> pa.Table:
        chunks_, blocks = group["chunk"].to_pylist(), group["block"].to_pylist()
        if group["shard"][0].as_py() < 0:
            return _table([(0, c, b) for c, b in zip(chunks_, blocks)], block_schema)
        return _table([(0, c, b) for c, b in _sorted_spans(chunks_, blocks, length)], block_schema)

    def remove(group: pa.Table, found: pa.Table) -> pa.Table:
        rows = []
        if group.num_rows:
            texts = _Texts(group)
            text, start, end = (x.astype(np.int64) for x in _joined(found["block"].to_pylist() if found.num_rows else [], *_SPAN))
            depth = np.bincount(texts.offsets[text] + start, minlength=len(texts.data) + 1) - np.bincount(texts.offsets[text] + end, minlength=len(texts.data) + 1)
            # a span that ends a text and one that begins the next one may touch
            gone = np.cumsum(depth)[:-1] > 0
            for i, (digest, raw) in enumerate(zip(texts.digests, texts.texts)):
                own = gone[texts.offsets[i]:texts.offsets[i + 1]]
                data = np.frombuffer(raw, np.uint8)
                number = int(own.sum())
                spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
                kept = data[~own].tobytes() if number else raw
                left = (data[~_whole_characters(data, own)].tobytes() if number else raw).decode() if keep_text else None
                first = int(texts.ids[i])
                rows.append((digest, None if first == LAST else first, len(raw), number, spans, hashlib.sha256(kept).hexdigest() if number else digest.hex(), left)[:len(result_schema)])
        return _table(rows, result_schema)

    texts_schema = pa.schema([("chunk", pa.int32()), ("digest", pa.binary()), ("doc_id", pa.int64()), ("text", pa.string())])
    block_schema = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("block", pa.binary())])
    result_schema = pa.schema([("digest", pa.binary()), ("first_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())] + [("kept", pa.string())] * keep_text)
    blocks = "shard int, chunk int, block binary"
    texts = _digested(docs).select(F.pmod(F.xxhash64("digest"), F.lit(chunks)).cast("int").alias("chunk"), "digest", "doc_id", "text")
    texts = small_batches(texts).mapInArrow(distinct, "chunk int, digest binary, doc_id long, text string")
    named = texts.groupBy("chunk").applyInArrow(find_names, blocks)
    shared = named.groupBy("shard").applyInArrow(share_names, blocks)
    routed = texts.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(route, blocks)
    spans = routed.groupBy("shard").applyInArrow(sort_runs, blocks)
    result = "digest binary, first_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * keep_text
    return texts.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(remove, result)


def _digested(docs: DataFrame, *columns: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(*columns, F.unhex(F.sha2(text, 256)).alias("digest"), F.col("doc_id").cast("long"), text.alias("text"))


def removals(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row."""
    found = by_text(docs, length, gram, hot=hot)
    return _each(_digested(docs).drop("text").join(found, "digest"), length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _each(rows: DataFrame, length: int) -> DataFrame:
    """Results by text, turned into those of each row: a later copy loses all, if it is long enough to lose any."""
    copied = F.col("first_id").isNotNull() & (F.coalesce(F.col("doc_id"), F.lit(LAST)) > F.col("first_id")) & (F.col("n_bytes") >= length)
    values = {"n_removed": F.col("n_bytes"), "n_spans": F.lit(1).cast("long"), "kept_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    values |= {"kept": F.lit("")} if "kept" in rows.columns else {}
    return rows.withColumns({name: F.when(copied, value).otherwise(F.col(name)) for name, value in values.items()})


def trim(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with what is left of their texts; rows that had text and have none left go.

    The texts come from the removal's result, so those of ``docs`` are not shuffled once more.
    """
    found = by_text(docs, length, gram, keep_text=True).withColumnRenamed("digest", "_digest")
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    others = F.struct(*[c for c in docs.columns if c != "text"])
    without = docs.select(others.alias("_row"), digest.alias("_digest"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").isNull().alias("_none"))
    rows = _each(without.join(found, "_digest"), length)
    rows = rows.where((F.col("kept") != "") | (F.col("n_bytes") == 0))
    text = F.when(~F.col("_none"), F.col("kept")).alias("text")
    return rows.select(*(text if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns))
