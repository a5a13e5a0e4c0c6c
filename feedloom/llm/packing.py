"""Cost-balanced packing of documents into token sequences.

Each document becomes its token ids and one end id, cut into pieces of at most ``capacity`` ids.  A piece
costs ``linear * n + quadratic * n * n``, the second part being attention inside the piece.  Pieces are
dealt into shards of about ``sequences`` sequences; in a shard the pieces, dearest first, each go to the
cheapest sequence with room left, and a sequence is opened only where none has room.

Defined results: a null text is empty and so holds the end id alone; repeated rows are packed once each; a
null ``doc_id`` stays null; pieces of equal cost go in the order of document, start and digest; an empty
table gives no rows.  Other columns of the input are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.texts import small_batches
from feedloom.session import work_path

CAPACITY = 2048
SEQUENCES = 1024
END_ID = 1
# Fixed values of the byte-level vocabulary: how it cuts text into words, and its one special token.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = "<|endoftext|>"
LONG_RUN = 65_536
LONG_SPACE = re.compile(rf"\s{{{LONG_RUN}}}")


def _byte_symbols() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """Text to ids, the same as ``tokenizers`` gives for the file without special tokens added.

    The vocabulary of the file is run by tiktoken, which is some six times faster; texts that hold the
    special token's own string, which only ``tokenizers`` knows, go there, and so do texts with very long runs
    of white space, on which tiktoken runs out of stack.
    """
    import tiktoken
    from tokenizers import Tokenizer

    exact, symbols = Tokenizer.from_file(path), _byte_symbols()
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    ranks = {bytes(symbols[c] for c in token): i for token, i in vocabulary.items() if token != SPECIAL}
    fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(text: str) -> list[int]:
        if SPECIAL in text or len(text) > LONG_RUN and LONG_SPACE.search(text):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return ids


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, nth`` and, on demand, ``ids``.

    ``nth`` tells repeated rows of a document in one batch apart; ``ids`` are little-endian 32-bit words.
    """
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("nth", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.binary())] * keep_ids)

    def cut(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            found = []
            for nth, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                ids = array("I", encode(text.as_py() or ""))
                ids.append(end_id)
                for start in range(0, len(ids), capacity):
                    part = np.asarray(ids[start:start + capacity], "<u4").tobytes()
                    found.append((doc_id, start, len(part) // 4, zlib.crc32(part), len(ids), nth, part)[:len(schema)])
            for i in range(0, len(found), 10_000):
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*found[i:i + 10_000]), schema)], schema=schema)

    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, nth long" + ", ids binary" * keep_ids
    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, kinds)


def place(lengths: np.ndarray, costs: np.ndarray, capacity: int) -> np.ndarray:
    """For pieces in the order given, the sequence each goes to: the cheapest with room, else a new one."""
    opened = -(-int(lengths.sum()) // capacity)
    room = np.full(opened, capacity, np.int64)
    spent = np.zeros(opened)
    chosen = np.empty(len(lengths), np.int64)
    for i, (length, cost) in enumerate(zip(lengths, costs)):
        at = int(np.where(room >= length, spent, np.inf).argmin())
        if room[at] < length:
            at = len(room)
            room, spent = np.append(room, capacity), np.append(spent, 0.0)
        room[at] -= length
        spent[at] += cost
        chosen[i] = at
    return chosen


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, linear: float = 1.0,
         quadratic: float = 1 / CAPACITY, sequences: int = SEQUENCES, keep_ids: bool = False) -> DataFrame:
    """Pieces with the ``sequence_id`` and ``offset`` they were given; see the module's text.

    Tokens are counted once: the pieces, without texts, are written to the shared folder, which also fixes
    them against lost executors.  The number of shards follows the token total, so a shard holds about
    ``sequences * capacity`` ids whatever the size of the table or the number of rows of one document.
    """
    spark = docs.sparkSession
    path = work_path(spark, "pieces")
    pieces(docs, vocabulary, capacity, end_id, keep_ids).write.parquet(path)
    cut = spark.read.parquet(path)
    total = cut.agg(F.sum("length")).first()[0] or 0
    shards = -(-total // (sequences * capacity)) or 1
    # a full piece fills a sequence alone and small ones fill gaps: both are spread evenly by the hash
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "nth"), F.lit(shards)).cast("int"))

    def assign(group: pa.Table) -> pa.Table:
        length = group["length"].to_numpy().astype(np.int64)
        cost = linear * length + quadratic * length.astype(float) ** 2
        known = group["doc_id"].fill_null(-1).to_numpy()
        order = np.lexsort((group["ids_crc32"].to_numpy(), group["start"].to_numpy(), known, -cost))
        chosen = place(length[order], cost[order], capacity)
        by_sequence = np.argsort(chosen, kind="stable")
        ends = np.cumsum(length[order][by_sequence])
        firsts = np.flatnonzero(np.r_[True, np.diff(chosen[by_sequence]) != 0])
        begins = ends - length[order][by_sequence]
        offset = begins - np.repeat(begins[firsts], np.diff(np.r_[firsts, len(begins)]))
        ids = (np.int64(group["shard"][0].as_py()) << 32) + chosen[by_sequence]
        kept = group.take(pa.array(order[by_sequence])).drop_columns(["shard", "nth"])
        return kept.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * keep_ids
    return dealt.groupBy("shard").applyInArrow(assign, f"{kinds}, sequence_id long, offset long")
