"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies by a score-ordered agenda.

A normalised text begins as its characters.  Every adjacent pair whose joined string is a piece waits in an
agenda, highest score first and the leftmost of equal ones; the pair on top becomes one symbol, its new
neighbours enter, and pairs that a merge has made stale are passed over.  What is left are the pieces;
a character that is none becomes the ids of its bytes, or the unknown id where the vocabulary has no byte pieces.

Where no piece runs from another character into a space mark, a merge cannot cross that place, so a text is cut
there first and equal segments of a task are merged once: the agenda's outcome in a segment does not depend on
others.  Short segments are merged many at a time, a matrix row each: every turn takes the top of each row's
agenda.  Long ones, and the texts of vocabularies with pieces that cross a mark, have a heap of their own, so
time grows with n log n.

The vocabulary is read from the model file, whose path has to exist on every executor.  In each Arrow batch
the sentencepiece library decodes the ids and encodes every segment merged there once more: ``agrees`` tells
whether its ids are the same in all segments of the row.  Chunks of a megabyte of texts are held at a time, or
one text if that is longer.

Defined results: a null text is empty; an empty text has no ids and decodes to an empty text; repeated rows
are encoded once each; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.texts import chunks

MARK = "▁"  # stands for a space inside pieces
SEGMENTS = 1 << 19  # segments a worker remembers at a time; older ones are merged again
WIDTHS = (4, 8, 12, 16, 24, 32)  # of the matrices; longer segments take the heap and are not remembered


class UnsupportedVocabulary(ValueError):
    """Not a merge-type vocabulary, or one with pieces the agenda has no rule for."""


def agenda(text: str, scores: dict[str, float]) -> list[str]:
    """The symbols that merging by score leaves of a text, in order."""
    symbols = list(text)
    n = len(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    waiting = []
    for i in range(n - 1):
        score = scores.get(symbols[i] + symbols[i + 1])
        if score is not None:
            waiting.append((-score, i, i + 1, 2))
    heapify(waiting)
    while waiting:
        _, left, right, size = heappop(waiting)
        joined = symbols[left] + symbols[right]
        if not symbols[left] or not symbols[right] or len(joined) != size:
            continue  # one of them has been merged meanwhile
        symbols[left], symbols[right] = joined, ""
        follower = after[left] = after[right]
        if follower >= 0:
            before[follower] = left
            score = scores.get(joined + symbols[follower])
            if score is not None:
                heappush(waiting, (-score, left, follower, size + len(symbols[follower])))
        leader = before[left]
        if leader >= 0:
            score = scores.get(symbols[leader] + joined)
            if score is not None:
                heappush(waiting, (-score, leader, left, size + len(symbols[leader])))
    return [s for s in symbols if s]


class Pairs:
    """Which two symbols join to a piece, and the rank of its score, in hash tables."""

    BITS = 20
    FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)

    def __init__(self, scores: dict[str, float]) -> None:
        alphabet = list(dict.fromkeys([*scores, *chain.from_iterable(scores)]))
        number = {symbol: i for i, symbol in enumerate(alphabet)}
        ranks = {score: i for i, score in enumerate(sorted(set(scores.values())))}
        found = sorted(
            (number[piece[:k]] << 32 | number[piece[k:]], number[piece], ranks[score])
            for piece, score in scores.items() for k in range(1, len(piece)) if piece[:k] in number and piece[k:] in number
        )
        self.alphabet = alphabet
        # the last entry, which no two symbols have, stands for no pair
        self.keys = np.array([*(f[0] for f in found), -1], np.int64)
        self.joined = np.array([*(f[1] for f in found), 0], np.int32)
        self.rank = np.array([*(f[2] for f in found), -1], np.int32)
        self.of_point = np.full(0x110000, -1, np.int32)
        for symbol, i in number.items():
            if len(symbol) == 1:
                self.of_point[ord(symbol)] = i
        # a pair whose place is taken goes to the next table; what is left after all of them is sought by order
        self.tables, left = [], np.arange(len(found))
        for factor in self.FACTORS:
            places = self._place(self.keys[left], factor)
            own = np.full(1 << self.BITS, len(found), np.int32)
            own[places] = left
            self.tables.append((factor, own))
            left = left[own[places] != left]
            if not len(left):
                break
        self.rest = left

    def _place(self, keys: np.ndarray, factor: int) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(factor)) >> np.uint64(64 - self.BITS)).view(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair, -1 where it is none, and the symbol it makes."""
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        none = len(self.keys) - 1
        at = np.full(len(keys), none, np.int32)
        open_ = np.flatnonzero((left >= 0).ravel() & (right >= 0).ravel())
        for factor, table in self.tables:
            sought = keys[open_]
            met = table[self._place(sought, factor)]
            hit = self.keys[met] == sought
            at[open_[hit]] = met[hit]
            open_ = open_[~hit & (met != none)]  # an empty place means that no later table has it
        if len(self.rest) and len(open_):
            held = self.keys[self.rest]
            met = np.minimum(np.searchsorted(held, keys[open_]), len(held) - 1)
            hit = held[met] == keys[open_]
            at[open_[hit]] = self.rest[met[hit]]
        at = at.reshape(left.shape)
        return self.rank[at], self.joined[at]

    def merge(self, segments: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        """``agenda`` of many segments of at most ``width`` characters.

        Symbols by number and whether they are still there, a row for each segment; a character of no piece is
        -2 less its code point.
        """
        n = len(segments)
        lengths = np.fromiter(map(len, segments), np.int64, n)
        points = np.frombuffer("".join(segments).encode("utf-32-le"), np.int32)
        inside = np.arange(width) < lengths[:, None]
        symbols = np.full((n, width + 1), -1, np.int32)  # the last column stands for no symbol
        known = self.of_point[points]
        symbols[:, :width][inside] = np.where(known < 0, -2 - points, known)
        places = np.arange(1, width + 2, dtype=np.int8)
        after = np.where(places < lengths[:, None], places, np.int8(width))
        before = np.broadcast_to(np.r_[width, np.arange(width)].astype(np.int8), (n, width + 1)).copy()
        rank, joined = self.look_up(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(n)
        while len(rows):
            best = rank[rows].argmax(1)  # the leftmost of equal ones
            rows, best = (x[rank[rows, best] >= 0] for x in (rows, best))
            right = after[rows, best]
            symbols[rows, best], symbols[rows, right] = joined[rows, best], -1
            rank[rows, right] = -1
            follower, leader = after[rows, right], before[rows, best]
            after[rows, best], before[rows, follower] = follower, best
            rank[rows, best], joined[rows, best] = self.look_up(symbols[rows, best], symbols[rows, follower])
            led = np.flatnonzero(leader < width)
            there, at = rows[led], leader[led]
            rank[there, at], joined[there, at] = self.look_up(symbols[there, at], symbols[there, best[led]])
        return symbols[:, :width], symbols[:, :width] != -1


class Encoder:
    """Texts to ids by the agenda, and back by the library."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        model, kinds = proto.ModelProto(), proto.ModelProto.SentencePiece
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE:
            raise UnsupportedVocabulary("the agenda needs a merge-type vocabulary")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise UnsupportedVocabulary("user-defined and unused pieces are not merged by score")
        self.library = SentencePieceProcessor(model_file=path)
        self.scores = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.unknown = self.library.unk_id()
        rules = model.normalizer_spec
        self.plain = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        self.plain = self.plain and not model.trainer_spec.treat_whitespace_as_suffix
        self.prefix = MARK if rules.add_dummy_prefix else ""
        crossing = any(re.search(f"[^{MARK}]{MARK}", piece) for piece in self.scores)
        self.cut = (lambda text: [text] if text else []) if crossing else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.pairs = Pairs(self.scores)
        self.id_of = np.array([self.ids.get(s, -1) for s in self.pairs.alphabet], np.int32)
        self.known: dict[str, bytes] = {}
        self.differing: set[str] = set()  # segments that the library encodes in another way

    def normalised(self, text: str) -> str:
        if not self.plain:
            return self.library.normalize(text)
        return self.prefix + text.replace(" ", MARK) if text else ""

    def _spelt(self, piece: str) -> list[int]:
        own = self.ids.get(piece)
        if own is not None:
            return [own]
        return [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown]

    def _merged(self, segments: list[str]) -> dict[str, bytes]:
        """The ids of segments as 32-bit words, those of about a length together."""
        groups: list[list[str]] = [[] for _ in range(len(WIDTHS) + 1)]
        for segment in segments:
            groups[bisect_left(WIDTHS, len(segment))].append(segment)
        found = {s: _packed(chain.from_iterable(map(self._spelt, agenda(s, self.scores)))) for s in groups.pop()}
        for width, same in zip(WIDTHS, groups):
            if not same:
                continue
            symbols, there = self.pairs.merge(same, width)
            flat = symbols[there]
            ids = np.where(flat >= 0, self.id_of[np.maximum(flat, 0)], flat)
            for x in np.flatnonzero(ids == -1):  # a character of pieces that is none itself
                ids[x] = -2 - ord(self.pairs.alphabet[flat[x]])
            ends = np.cumsum(there.sum(1))
            blob, cuts = ids.tobytes(), (4 * ends).tolist()
            found |= zip(same, [blob[i:j] for i, j in zip([0, *cuts], cuts)])
            for i in np.unique(np.searchsorted(ends, np.flatnonzero(ids < 0), "right")):
                own = np.frombuffer(found[same[i]], np.int32).tolist()
                found[same[i]] = _packed(chain.from_iterable([x] if x >= 0 else self._spelt(chr(-2 - x)) for x in own))
        return found

    def _check(self, made: dict[str, bytes]) -> None:
        """Whether the library gives the same ids; it puts the prefix in itself, but before no empty text."""
        lead = len(self.prefix)
        made = {s: own for s, own in made.items() if len(s) > lead}
        theirs = self.library.encode([s[lead:] for s in made], num_threads=1)
        if _packed(chain.from_iterable(theirs)) != b"".join(made.values()) or [4 * len(x) for x in theirs] != list(map(len, made.values())):
            self.differing |= {s for (s, own), other in zip(made.items(), theirs) if own != _packed(other)}

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        """The ids of each text, and whether the library agrees."""
        cut = [self.cut(self.normalised(text)) for text in texts]
        if len(self.known) > SEGMENTS:
            self.known.clear()
            self.differing.clear()
        # against the dict itself: taking its keys off a set walks through all that is remembered
        made = self._merged(list(set().union(*cut).difference(self.known)))
        self.known |= made
        ids = [np.frombuffer(b"".join(map(self.known.__getitem__, segments)), np.int32) for segments in cut]
        if not self.bytes:  # unknown pieces in a row are one
            ids = [own[~np.r_[False, (own[1:] == self.unknown) & (own[:-1] == self.unknown)][:len(own)]] for own in ids]
        if self.plain and self.bytes:
            self._check(made)
            same = [not self.differing or self.differing.isdisjoint(segments) for segments in cut]
        else:
            same = [a.tolist() == b for a, b in zip(ids, self.library.encode(texts, num_threads=1))]
        for segment in made:
            if len(segment) > WIDTHS[-1]:
                del self.known[segment]
        return ids, same


def _packed(ids) -> bytes:
    return np.fromiter(ids, np.int32).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, vocabulary: str, *columns: str | Column, text: str = "text") -> DataFrame:
    """The columns asked for with ``ids``, ``decoded`` and ``agrees``, a row for each row."""
    kept = docs.select(*columns)
    names = [*kept.columns, "ids", "decoded", "agrees"]

    def run(batches):
        known = encoder(vocabulary)
        for batch in batches:
            own, column = batch.columns[:-1], batch.column(batch.num_columns - 1)
            for chunk in chunks(column):
                texts = [t or "" for t in column.slice(chunk.rows.start, len(chunk)).to_pylist()]
                ids, same = known.encode(texts)
                decoded = known.library.decode([x.tolist() for x in ids])
                ends = np.r_[0, np.cumsum([len(x) for x in ids])]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
                here = [c.slice(chunk.rows.start, len(chunk)) for c in own]
                yield pa.record_batch([*here, lists, pa.array(decoded, pa.string()), pa.array(same)], names=names)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "ids array<int>, decoded string, agrees boolean"])
    return docs.select(*columns, F.col(text).alias("_encoded_text")).mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """``ids`` and ``decoded`` as a count and two digests; the other columns stay."""
    others = [c for c in encoded.columns if c not in ("ids", "decoded")]
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        *others, F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
