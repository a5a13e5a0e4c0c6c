"""Near duplicates by Order MinHash over word shingles, verified by banded alignment.

A text is the sequence of its shingles (``size`` consecutive words), each labelled with how often it has
occurred before.  A sketch is the ``picked`` labelled shingles with the smallest hashes, in text order, so two
texts share a sketch if they share those shingles in the same order; ``sketches`` hash functions give as many
sketches.  Every other function leaves repeated occurrences out, so that a line repeated a hundred times does
not fill all sketches.  Texts that share a sketch and whose lengths allow it are candidates.  A candidate pair
is aligned: with L the longest common subsequence of the two sequences of first occurrences, found inside the
band of shifts that the threshold leaves possible, the similarity is L / (m + n - L), which for texts in the
same order is the Jaccard similarity of their shingles.  Repetition alone makes no two texts alike.  Links of
at least ``threshold`` join documents into classes.

Texts of the same words are one text from the start.  Of the texts that share a sketch, each is first paired
with a few leaders (the least id, the shortest, one by hash), which joins groups of copies without pairing
them all, and texts that are little more than a passage they share, since nothing is nearer to all of those
than the shortest.  Then all pairs across the classes so far are taken.  Where a sketch has more of those than
``spread`` per text (a passage inside many texts), its texts are joined by their rarest shingles instead, which
finds every pair of them that has enough in common.  Nothing is capped.

Defined results: upper case A-Z, punctuation and spacing don't count; texts of fewer words than a shingle
are alike only if all words are; a text without words, null or empty, is its own class, as is a row without
``doc_id``, whose class is null; repeated rows fall into one class; of several texts with one id the one with
the least signature is compared and the others are classes of their own.  Other columns are kept as they are.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.components import components
from feedloom.llm.texts import BASE, WORD, Words, binary, chunks, mixed, powers, small_batches, words
from feedloom.session import work_path

SHINGLE = 5
SKETCHES = 16
PICKED = 2
THRESHOLD = 0.8
NOT_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"  # what is left out of words, before lower-casing
SPREAD = 8
BLOCK = 1024  # texts of one shingle that meet as a block
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(found: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each document, and where each document's begin; one more at the end.

    A text with fewer words, but some, is one shingle of its own.
    """
    first, lengths = found.first[:-1], np.diff(found.first)
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    ends = np.r_[0, np.cumsum(counts)]
    start = np.arange(ends[-1]) - np.repeat(ends[:-1] - first, counts)
    here = np.repeat(np.minimum(lengths, size), counts)
    hashes = np.zeros(len(start), np.uint64)
    for k in range(size):
        at = np.minimum(start + k, max(len(found.hash) - 1, 0))
        hashes = hashes * BASE + np.where(k < here, found.hash[at] if len(found.hash) else 0, np.uint64(k + 1))
    return mixed(hashes), ends


def labelled(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes in which the nth occurrence of a shingle in a document differs from the others."""
    document = np.repeat(np.arange(len(ends) - 1, dtype=np.uint64), np.diff(ends))
    keys = mixed(hashes + document * BASE)
    ordered = np.sort(keys)
    repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(repeated):
        return hashes
    at = np.minimum(np.searchsorted(repeated, keys), len(repeated) - 1)
    members = np.flatnonzero(repeated[at] == keys)
    members = members[np.argsort(keys[members], kind="stable")]
    heads = np.flatnonzero(np.r_[True, keys[members][1:] != keys[members][:-1]])
    nth = np.arange(len(members)) - np.repeat(heads, np.diff(np.r_[heads, len(members)]))
    result = hashes.copy()
    result[members] = np.where(nth > 0, mixed(hashes[members] + nth.astype(np.uint64) * BASE), hashes[members])
    return result


def sketch(labels: np.ndarray, again: np.ndarray, ends: np.ndarray, sketches: int = SKETCHES, picked: int = PICKED) -> np.ndarray:
    """A row of sketches for each document that has shingles; ``again`` marks occurrences after the first."""
    starts = ends[:-1][np.diff(ends) > 0]
    counts = np.diff(np.r_[starts, len(labels)])
    of = np.repeat(np.arange(len(starts)), counts)
    result = np.zeros((len(starts), sketches), np.uint64)
    for function in range(sketches):
        order = (labels ^ mixed(np.uint64([function + 1]))) * BASE
        order ^= order >> np.uint64(29)
        order *= np.uint64(0xD6E8FEB86659FD93)
        order ^= order >> np.uint64(32)
        if function % 2:
            order[again] = NONE
        places = []
        for _ in range(picked):
            least = np.minimum.reduceat(order, starts)
            at = np.flatnonzero(order == least[of])
            at = at[np.searchsorted(of[at], np.arange(len(starts)))]  # equal hashes: the first
            places.append(np.where(least == NONE, -1, at))
            order[at] = NONE
        for place in np.sort(np.stack(places), axis=0):  # in text order
            result[:, function] = mixed(result[:, function] * BASE + np.where(place < 0, np.uint64(0), labels[place]))
    return result


def signature(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each document's sequence of words."""
    power, inverse = powers(len(found.hash) + 1), powers(len(found.hash) + 1, True)
    halves = []
    for values in (found.hash, mixed(found.hash ^ BASE)):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[:len(values)], out=total[1:])
        halves.append(mixed((total[found.first[1:]] - total[found.first[:-1]]) * inverse[found.first[:-1]]))
    return halves[0], halves[1]


def _in_order(j: np.ndarray) -> int:
    """Length of the longest rising subsequence."""
    if len(j) < 2 or (np.diff(j) > 0).all():
        return len(j)
    tails: list[int] = []
    for x in j.tolist():
        at = bisect_left(tails, x)
        if at == len(tails):
            tails.append(x)
        else:
            tails[at] = x
    return len(tails)


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """L / (m + n - L) of two sequences without repetition if that is ``threshold`` or more, else 0.

    L is sought inside the band the threshold allows.
    """
    m, n = len(a), len(b)
    need = int(np.ceil(threshold * (m + n) / (1 + threshold) - 1e-9))
    if not m or not n or need > min(m, n):
        return 0.0
    short = min(m, n)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    differ = np.flatnonzero(a[m - short + head:][::-1] != b[n - short + head:][::-1])
    tail = int(differ[0]) if len(differ) else short - head
    x, y = a[head:m - tail], b[head:n - tail]
    low, high = need - m, n - need  # shifts that leave enough to match
    common = 0
    if len(x) and len(y):
        order = np.argsort(y, kind="stable")
        at = np.minimum(np.searchsorted(y[order], x), len(y) - 1)
        i = np.flatnonzero(y[order[at]] == x)
        j = order[at[i]]
        inside = (j - i >= low) & (j - i <= high)
        common = _in_order(j[inside])
    total = head + tail + common
    found = total / (m + n - total)
    return found if found >= threshold - 1e-12 else 0.0


def sketched(docs: DataFrame, size: int = SHINGLE, sketches: int = SKETCHES, picked: int = PICKED) -> DataFrame:
    """``doc_id, n, s1, s2, sketches`` of the rows with an id and words; ``n`` counts different shingles."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("sketches", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                found = words(chunk, WORD)
                hashes, ends = shingles(found, size)
                counts = np.diff(ends)
                some = np.flatnonzero(counts)
                if not len(some):
                    continue
                labels = labelled(hashes, ends)
                again = labels != hashes
                counts = counts - np.diff(np.r_[0, np.cumsum(again)][ends])
                rows = sketch(labels, again, ends, sketches, picked)
                s1, s2 = signature(found)
                ids = batch.column(0).slice(chunk.rows.start, len(chunk)).take(pa.array(some))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * sketches, pa.int32()), pa.array(rows.ravel().view(np.int64)))
                yield pa.record_batch([ids, pa.array(counts[some]), pa.array(s1[some].view(np.int64)), pa.array(s2[some].view(np.int64)), lists], schema=schema)

    known = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    return known.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, sketches array<long>")


def sequences(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, s1, s2, sequence``: 32 bits of each shingle's first occurrence in order, enough between two texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("sequence", pa.binary())])

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                found = words(chunk, WORD)
                hashes, ends = shingles(found, size)
                s1, s2 = signature(found)
                once = labelled(hashes, ends) == hashes
                short = (hashes[once] >> np.uint64(32)).astype(np.uint32)
                cuts = np.r_[0, np.cumsum(once)][ends]
                blobs = [binary(short[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.record_batch([batch.column(0).slice(chunk.rows.start, len(chunk)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array(blobs, pa.binary())], schema=schema)

    return docs.mapInArrow(run, "doc_id long, s1 long, s2 long, sequence binary")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``a, b, similarity`` of the pairs that align."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def run(batches):
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            found = [similarity(np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32), threshold) for x, y in zip(left, right)]
            kept = np.flatnonzero(np.array(found) > 0)
            yield pa.record_batch([batch.column(0).take(pa.array(kept)), batch.column(1).take(pa.array(kept)), pa.array(np.array(found)[kept])], schema=schema)

    left = texts.select(F.col("doc_id").alias("a"), F.col("sequence").alias("left"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("sequence").alias("right"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return both.mapInArrow(run, "a long, b long, similarity double")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _alike(threshold: float):
    """What the lengths of two texts allow."""
    return F.least("n_a", "n_b") >= F.lit(threshold - 1e-9) * F.greatest("n_a", "n_b")


def _led(members: DataFrame, threshold: float) -> DataFrame:
    """Pairs of each member of a bucket with its leaders: the least id, the shortest, and one by hash."""
    text = F.struct(F.col("doc_id").alias("a"), F.col("n").alias("n_a"))
    orders = (F.struct("doc_id"), F.struct("n", "doc_id"), F.struct(F.xxhash64("doc_id", F.lit(1)), "doc_id"))
    first = [F.min_by(text, order).alias(f"l{i}") for i, order in enumerate(orders)]
    chosen = members.groupBy("at", "key").agg(F.count("*").alias("size"), *first).where("size > 1")
    chosen = chosen.select("at", "key", F.array(*(f"l{i}" for i in range(len(orders)))).alias("leaders"))
    # a text meets mostly the same leaders in all its buckets: they are gathered, a few per sketch, before pairs are made
    met = members.join(chosen, ["at", "key"]).groupBy(F.col("doc_id").alias("b"), F.col("n").alias("n_b")).agg(F.array_distinct(F.flatten(F.collect_list("leaders"))).alias("leaders"))
    pairs = met.select("b", "n_b", F.explode("leaders").alias("leader")).select("b", "n_b", "leader.*")
    return pairs.where((F.col("a") != F.col("b")) & _alike(threshold)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _crossed(named: DataFrame, spread: int) -> DataFrame:
    """The members of buckets that hold several classes, and whether those make too many pairs."""
    per_class = named.groupBy("at", "key", "c").agg(F.count("*").alias("k"))
    sizes = per_class.groupBy("at", "key").agg(F.sum("k").alias("m"), F.sum(F.col("k") * F.col("k")).alias("q"))
    wide = (F.col("m") * F.col("m") - F.col("q")) / 2 > F.lit(spread) * F.col("m")
    return _written(named.join(sizes.where("q < m * m").select("at", "key", wide.alias("wide")), ["at", "key"]), "members")


def _between(narrow: DataFrame, threshold: float) -> DataFrame:
    """Pairs of members of a bucket that are in different classes."""
    left = narrow.select("at", "key", F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("c").alias("c_a"))
    right = narrow.select("at", "key", F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("c").alias("c_b"))
    met = left.join(right, ["at", "key"])
    return met.where((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & _alike(threshold)).select("a", "b")


def _shared_shingles(texts: DataFrame) -> DataFrame:
    """``doc_id, shingle, n`` of the shingles that several texts hold, with how many, and ``size``, those of the text."""
    schema = pa.schema([("doc_id", pa.int64()), ("size", pa.int64()), ("shingle", pa.int64())])

    def run(batches):
        for batch in batches:
            for doc_id, blob in zip(batch.column(0), batch.column(1)):
                own = np.unique(np.frombuffer(blob.as_buffer(), np.uint32)).astype(np.int64)
                ids = pa.array(np.full(len(own), doc_id.as_py(), np.int64))
                yield pa.record_batch([ids, pa.array(np.full(len(own), len(own), np.int64)), pa.array(own)], schema=schema)

    held = texts.select("doc_id", "sequence").mapInArrow(run, "doc_id long, size long, shingle long")
    return held.join(held.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "shingle")


def _rare(named: DataFrame, texts: DataFrame, threshold: float, block: int) -> DataFrame:
    """All pairs of different classes that may be alike by the number of their shingles in common.

    Shingles are ordered from rare to frequent.  The first one that two texts have in common leaves room for the
    others only behind it, so in texts of sizes m and n it stands before the last t (m + n) / (1 + t) - 1 of both.
    A text is therefore looked up by its rarest shingles alone, and a passage inside many texts brings two together
    only if it is nearly all of both.  Texts of one shingle meet in blocks, each pair of blocks in a group of its own.
    """
    held = _shared_shingles(texts.join(named.select("doc_id").distinct(), "doc_id", "left_semi"))
    ordered = held.groupBy("doc_id", "size").agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("s"))
    # what no other text holds comes first of all; the least size of a partner gives the longest beginning
    alone = F.col("size") - F.size("s")
    first = F.floor(F.col("size") - F.lit(threshold) * F.col("size") + F.lit(1e-6)).cast("int") + 1 - alone
    begun = ordered.select("doc_id", F.col("size").alias("n"), alone.alias("alone"), F.slice("s", 1, F.greatest(first, F.lit(0)).cast("int")).alias("s"))
    keyed = begun.select("doc_id", "n", (F.col("n") - F.col("alone")).alias("left"), F.posexplode("s").alias("place", "one"))
    keyed = keyed.select("doc_id", "n", (F.col("left") - F.col("place")).alias("left"), F.col("one.shingle").alias("shingle"))
    keyed = keyed.join(named.select("doc_id", "c").distinct(), "doc_id")
    sizes = keyed.groupBy("shingle", "c").agg(F.count("*").alias("k")).groupBy("shingle").agg(F.sum("k").alias("m"), F.count("*").alias("classes"))
    several = sizes.where("classes > 1").select("shingle", F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    dealt = _written(keyed.join(several, "shingle"), "shingles")
    own = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))

    def side(x, row, column):
        return dealt.select("shingle", row.alias("row"), column.alias("column"), F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("left").alias(f"left_{x}"), F.col("c").alias(f"c_{x}"))

    met = side("a", own, others).join(side("b", others, own), ["shingle", "row", "column"])
    enough = F.least("left_a", "left_b") >= F.lit(threshold / (1 + threshold)) * (F.col("n_a") + F.col("n_b")) - F.lit(1e-6)
    return met.where((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & enough).select("a", "b").distinct()


def _across(members: DataFrame, classes: DataFrame, texts: DataFrame, spread: int, threshold: float, block: int) -> DataFrame:
    """Pairs of different classes that share a sketch, or enough rare shingles where sketches are shared too widely."""
    named = members.join(classes, F.col("doc_id") == F.col("node"), "left").select("at", "key", "doc_id", "n", F.coalesce("component", "doc_id").alias("c"))
    here = _crossed(named, spread)
    pairs = _between(here.where("not wide"), threshold)
    return pairs.union(_rare(here.where("wide").select("doc_id", "c").distinct(), texts, threshold, block)).distinct()


def links(docs: DataFrame, rows: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, spread: int = SPREAD, block: int = BLOCK) -> DataFrame:
    """``a, b, similarity`` between texts of different words, ``a < b``; enough of them to join every class.

    ``rows`` is what ``sketched`` gives for ``docs``.
    """
    one = rows.groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id"), F.any_value("n").alias("n"), F.any_value("sketches").alias("sketches"))
    one = one.groupBy("doc_id").agg(F.min_by(F.struct("s1", "s2", "n", "sketches"), F.struct("s1", "s2")).alias("t")).select("doc_id", "t.*")
    spread_out = one.select("doc_id", "s1", "s2", "n", F.posexplode("sketches").alias("place", "key"))
    keyed = spread_out.select(F.col("place").cast("string").alias("at"), "key", "doc_id", "s1", "s2", "n")
    shared = keyed.groupBy("at", "key").agg(F.count("*").alias("size")).where("size > 1").drop("size")
    members = _written(keyed.join(shared, ["at", "key"]), "buckets")
    wanted = members.select("doc_id", "s1", "s2").distinct()
    # a repeated id with another text is left out by the signature
    read = docs.select(F.col("doc_id").cast("long"), "text").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    texts = _written(sequences(read, size).join(wanted, ["doc_id", "s1", "s2"], "left_semi").dropDuplicates(["doc_id"]), "sequences")
    first = _written(_verified(_led(members, threshold), texts, threshold), "links")
    rest = _across(members, components(first), texts, spread, threshold, block)
    return _written(first.union(_verified(rest, texts, threshold)), "links").dropDuplicates(["a", "b"])


def classes(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, sketches: int = SKETCHES, picked: int = PICKED,
            spread: int = SPREAD, block: int = BLOCK) -> DataFrame:
    """``doc_id, class_id, n_links`` for each row; a class is named by its least id.

    ``n_links`` counts the links found between the document's words and others in the class.
    """
    rows = _written(sketched(small_batches(docs), size, sketches, picked), "sketches")
    found = links(docs, rows, size, threshold, spread, block)
    joined = components(found)
    counts = found.select(F.explode(F.array("a", "b")).alias("text_id")).groupBy("text_id").agg(F.count("*").alias("n_links"))
    one = rows.groupBy("s1", "s2").agg(F.min("doc_id").alias("text_id"))
    compared = one.groupBy("text_id").agg(F.min(F.struct("s1", "s2")).alias("t")).select("text_id", "t.*")
    linked = compared.join(counts, "text_id").join(joined, F.col("text_id") == F.col("node")).select("s1", "s2", "component", "n_links")
    per_text = one.join(linked, ["s1", "s2"], "left")
    per_text = per_text.select("s1", "s2", F.coalesce("component", "text_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    # rows without words are in no class with others
    named = rows.join(per_text, ["s1", "s2"]).select("doc_id", "class_id", "n_links")
    apart = docs.select(F.col("doc_id").cast("long")).join(rows.select("doc_id").distinct(), "doc_id", "left_anti")
    return named.union(apart.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long")))


def deduplicate(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stand for their class: those of its least id, equal ones once.

    Rows without words and rows without an id all stay.
    """
    kept = classes(docs, **settings).where("doc_id = class_id").select(F.col("doc_id").alias("id")).distinct()
    has_words = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), NOT_WORDS, "")) > 0
    key = [F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash")]
    # which texts an id holds twice is found on narrow rows; only those texts are gathered
    twice = docs.where(F.col("doc_id").isNotNull() & has_words).select(*key).groupBy("id", "hash").agg(F.count("*").alias("n")).where("n > 1")
    known = _written(kept.join(twice.groupBy("id").agg(F.collect_list("hash").alias("again")), "id", "left"), "kept")
    held = docs.select(*key, F.struct(*docs.columns).alias("row")).join(known, "id")
    # a test that needs both sides of the join: its two outcomes read the same shuffle of the texts
    several = F.coalesce(F.array_contains("again", F.col("hash")), F.lit(False))
    once = held.where(several).groupBy("id", "hash").agg(F.any_value("row").alias("row"))
    return held.where(~several).select("row").unionByName(once.select("row")).select("row.*").unionByName(docs.where(F.col("doc_id").isNull()))
