"""Every operator against a plain version of it, and on rows that are odd in some way."""

from __future__ import annotations

import hashlib
import html.parser
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.llm import components, decontamination, licenses, neighbours, ngrams, order_minhash, packing, quality, repeats, suffix_sort, texts, toxicity, warc

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n long, key string, class_id long, label int"
WORDS = "the of and river stone apple quiet winter garden yellow morning paper engine harbour silver window travel copper".split()


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(300)) for _ in range(n))


def table(spark, rows):
    full = [(i, t, None, None, None, 1.0, 2, "k", 3, 4) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, a repeated id, columns with names the operators use."""
    base = prose(1, 120)
    rows = [(1, base), (2, None), (3, ""), (4, base), (4, base), (5, "x"), (None, base), (None, None), (6, "é" * 60 + "idiot " * 5000), (7, base + " tail"), (5, "other words than before"), (8, "!!! ..."), (9, "...")]
    return table(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


def test_words_and_hashes_follow_the_bytes():
    found = ["Ab c", "", None, "x", "  y z  ", "É1-é2"]
    (chunk,) = texts.chunks(pa.array(found))
    w = texts.words(chunk, texts.WORD)
    assert [(w.first[i + 1] - w.first[i]) for i in range(len(found))] == [len(words(t)) for t in found]
    assert [int(h) for h in w.hash] == [texts.word_hash(x) for t in found for x in words(t)]
    assert sum(len(c) for c in texts.chunks(pa.array(["abc"] * 50), 10)) == 50


# packing


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_tokenizer(text):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(VOCABULARY)
    for t in (text, text + packing.SPECIAL + " a", "It's 12 o'clock \n\n  x"):
        assert packing.encoder(VOCABULARY)(t) == exact.encode(t, add_special_tokens=False).ids


def test_packing_covers_every_id_once(spark, odd, none):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(VOCABULARY)
    docs = odd.union(table(spark, [(100 + i, prose(i, 40 * i)) for i in range(40)]))
    found = packing.pack(docs, VOCABULARY, capacity=256, sequences=8, keep_ids=True).collect()
    per_doc, per_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        per_sequence[r.sequence_id].append((r.offset, r.length))
        per_doc[r.doc_id].append((r.start, tuple(np.frombuffer(bytes(r.ids), "<u4"))))
    for parts in per_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    wanted = Counter()
    for r in docs.collect():
        ids = [*exact.encode(r.text or "", add_special_tokens=False).ids, packing.END_ID]
        wanted.update((r.doc_id, s, tuple(ids[s:s + 256])) for s in range(0, len(ids), 256))
    assert Counter((d, s, i) for d, parts in per_doc.items() for s, i in parts) == wanted
    assert sum(r.length for r in found) / (256 * len(per_sequence)) > 0.9  # eight sequences a shard leave more room than many
    assert packing.pack(none, VOCABULARY).count() == 0


def test_pieces_go_to_the_cheapest_sequence_with_room():
    chosen = packing.place(np.array([8, 6, 4, 2]), np.array([80.0, 50, 20, 8]), 10)
    assert chosen.tolist() == [0, 1, 1, 0]


# language model


def brute_scores(rows):
    def tokens(t):
        return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), "</s>"]

    read = [(i, h, tokens(t)) for i, h, t in rows]
    pairs = Counter((v, w) for _, held, ts in read if not held for v, w in zip(["<s>", *ts], ts))
    count, context, kinds, before = Counter(), Counter(), defaultdict(Counter), Counter()
    for (v, w), c in pairs.items():
        count[w] += c
        context[v] += c
        kinds[v][min(c, 3)] += 1
        before[w] += 1

    def discounts(of):
        n = [0, *(sum(1 for c in of.values() if c == k) for k in (1, 2, 3, 4))]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        return [0, *(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) if n[k] else 0 for k in (1, 2, 3))]

    high, low, types = discounts(pairs), discounts(before), len(count)
    left = sum(low[min(k, 3)] for k in before.values()) / len(pairs) if pairs else 1
    first = lambda w: max(before[w] - low[min(before[w], 3)], 0) / max(len(pairs), 1) + left / (types + 1)

    def chance(v, w):
        if not context[v]:
            return first(w)
        return max(pairs[v, w] - high[min(pairs[v, w], 3)], 0) / context[v] + sum(high[k] * kinds[v][k] for k in (1, 2, 3)) / context[v] * first(w)

    total = sum(count.values())
    for i, held, ts in read:
        base = sum(math.log10((count[t] + 0.5) / (total + 0.5 * (types + 1))) for t in ts)
        yield i, len(ts), sum(count[t] > 0 for t in ts), total, base, sum(math.log10(chance(v, w)) for v, w in zip(["<s>", *ts], ts))


def test_bigram_scores(spark, odd, none, monkeypatch):
    monkeypatch.setattr(ngrams, "SHARD_BYTES", 4000)  # several shards
    docs = odd.union(table(spark, [(100 + i, prose(i % 7, 60)) for i in range(20)])).withColumn("held", F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False)))
    model = ngrams.fit(docs.where("not held"))
    assert model.shards > 1
    found = sorted(tuple(r) for r in ngrams.score(docs, model, F.coalesce("doc_id", F.lit(-1))).drop("perplexity").collect())
    wanted = sorted(brute_scores([(-1 if r.doc_id is None else r.doc_id, r.held, r.text) for r in docs.collect()]))
    for a, b in zip(found, wanted, strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:])
    model.drop()
    empty = ngrams.fit(none)
    assert empty.tokens == 0 and ngrams.score(none, empty, "doc_id").count() == 0
    assert ngrams.score(docs, empty, "doc_id").agg(F.max(F.abs("score"))).first()[0] == 0


# suffix sorting and repeats


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=40, max_size=300), st.integers(1, 3), st.integers(17, 34), st.sampled_from([8, 16]))
def test_deep_shallow_order(data, letters, depth, shallow):
    text = np.frombuffer(data, np.uint8) % (letters + 1)
    starts = np.arange(len(text) - depth + 1)
    order, new = suffix_sort.deep_shallow(text, starts, depth, shallow)
    strings = [text[i:i + depth].tobytes() for i in order]
    assert strings == sorted(strings) and sorted(order) == list(starts)
    assert new.tolist() == [True, *(a != b for a, b in zip(strings, strings[1:]))][:len(strings)]


def brute_removals(rows, length):
    first = {}
    for i, raw in rows:
        for k in range(len(raw) - length + 1):
            s = raw[k:k + length]
            first[s] = min(first.get(s, math.inf), i)
    for i, raw in rows:
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if first[raw[k:k + length]] < i:
                gone[k:k + length] = b"\1" * length
        spans = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        yield i, len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()


def test_repeated_passages(spark, odd, none, monkeypatch):
    monkeypatch.setattr(repeats, "SORT_SHARD", 2000)
    monkeypatch.setattr(repeats, "NAME_SHARD", 4000)
    shared, junk = prose(50, 25), "-" * 400
    rows = [(100 + i, prose(i, 20) + shared + prose(i + 1, 15) + junk[:i * 20] + prose(i % 5, 30)) for i in range(30)]
    docs = odd.union(table(spark, rows))
    last = repeats.LAST
    found = sorted((last if r[0] is None else r[0], *r[1:]) for r in repeats.removals(docs).collect())
    wanted = sorted(brute_removals([(last if r.doc_id is None else r.doc_id, (r.text or "").encode()) for r in docs.collect()], 50))
    assert found == wanted
    kept = repeats.trim(docs)
    assert kept.columns == docs.columns
    lengths = {(r[0], r[4]) for r in found}
    for r in kept.collect():  # whole characters stay, so a few bytes more may be left
        own = (r.text or "").encode()
        assert r.doc_id is None or r.doc_id in (5, 6) or (r.doc_id, hashlib.sha256(own).hexdigest()) in lengths
    assert repeats.removals(none).count() == 0 and repeats.trim(none).count() == 0


def test_a_frequent_phrase_fills_no_shard(spark):
    """Its strings, with other bytes around the phrase in each text, part by their own hashes; results stay."""
    phrase, shards = "a phrase that all of them hold. ", 16
    rows = [(i, hashlib.sha256(b"%d" % i).hexdigest() + phrase + hashlib.sha256(b"-%d" % (i % 150)).hexdigest()) for i in range(300)]
    held = pa.table({"digest": [hashlib.sha256(t.encode()).digest() for _, t in rows], "doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    found = repeats._Texts(held)
    names, _, _, many = repeats.runs(found.data, found.offsets, 50, 16)
    shared, of = np.unique(names, return_inverse=True)
    strings = np.bincount(of, many)
    assert strings.max() > 1000
    filled = {s: repeats._unpack(b, *repeats._RUN)[3].sum() for s, _, b in repeats._routes(found, shared, strings > 200, 50, 16, shards, 0) if s >= 0}
    assert max(filled.values()) < 2 * sum(filled.values()) / shards
    docs = table(spark, rows)
    cut, whole = ({tuple(r) for r in repeats.removals(docs, hot=hot).collect()} for hot in (8, 1 << 40))
    assert cut == whole and sum(r[2] > 0 for r in cut) == 150


# near duplicates


def brute_similarity(a, b):
    def lcs(x, y):
        row = [0] * (len(y) + 1)
        for i in x:
            new = [0]
            for j, k in enumerate(y):
                new.append(row[j] + 1 if i == k else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    def one(x, y):
        same = lcs(x, y)
        return same / (len(x) + len(y) - same)

    return one(a, b)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 90), min_size=1, max_size=80), st.lists(st.tuples(st.integers(0, 60), st.integers(0, 90)), max_size=8))
def test_banded_alignment(sequence, edits):
    other = list(sequence)
    for at, value in edits:
        if at % 3 == 0:
            other.insert(at % (len(other) + 1), value)
        elif len(other) > 1 and at % 3 == 1:
            del other[at % len(other)]
        else:
            other[at % len(other)] = value
    sequence, other = list(dict.fromkeys(sequence)), list(dict.fromkeys(other))
    wanted = brute_similarity(sequence, other)
    found = order_minhash.similarity(np.array(sequence, np.uint32), np.array(other, np.uint32), 0.8)
    assert found == (pytest.approx(wanted) if wanted >= 0.8 - 1e-12 else 0.0)


def near_rows():
    """Groups of edited copies, a passage that many texts share, and texts with nothing in common."""
    r, rows = random.Random(5), []
    passage = prose(999, 60)
    for g in range(6):
        base = prose(g, 150).split()
        for c in range(8):
            own = list(base)
            for _ in range(c % 4):
                own[r.randrange(len(own))] = f"edit{r.randrange(10 ** 6)}"
            rows.append((1000 + 50 * g + c, " ".join(own)))
    rows += [(2000 + i, passage + " " + prose(5000 + i, 12 + i % 30)) for i in range(60)]
    rows += [(3000 + i, passage + f" end{i}") for i in range(6)]
    rows += [(3500 + i, prose(8000 + i, 40) + " is so." * 150) for i in range(20)]  # a line repeated makes nothing alike
    return rows + [(4000 + i, prose(7000 + i, 80)) for i in range(40)]


def test_near_duplicate_classes(spark, odd, none):
    docs = odd.union(table(spark, near_rows()))
    found = [(r.doc_id, r.class_id) for r in order_minhash.classes(docs, spread=1).collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(i for i, _ in found) == Counter(i for i, _ in rows)
    named = {i: c for i, c in found if i is not None and i != 5}
    sets = {}
    for i, t in rows:
        w = words(t)
        if i in named and w:
            sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4)))
    parent = {i: i for i in named}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    assert named == {i: top(i) for i in named}
    kept = order_minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    stay = Counter(r.doc_id for r in kept.collect())
    assert stay == Counter({**{c: 1 for c in named.values()}, 5: 2, None: 2})
    assert order_minhash.classes(none).count() == 0 and order_minhash.deduplicate(none).count() == 0


def template_rows():
    """Texts that share a long passage; those of one family are alike only to the one before and after it."""
    rows, template = [], prose(555, 70)
    for g in range(30):
        tail = prose(600 + g, 40).split()
        for c in range(3):
            rows.append((100 * (c + 1) + g, template + " " + " ".join(tail[c * 6:c * 6 + 28])))
    return rows


@pytest.mark.parametrize("block", [7, 1024])
def test_texts_with_one_template_are_linked_to_any_partner(spark, block):
    rows = template_rows()
    sets = {i: frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) for i, t in rows for w in [words(t)]}
    wanted = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert len(wanted) == 60
    # 90 texts in a bucket, most of them in classes of their own, and none near a leader of all
    joined = {r.doc_id: r.class_id for r in order_minhash.classes(table(spark, rows), spread=1, block=block).collect()}
    assert joined == {i: 100 + i % 100 for i, _ in rows}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 300), (200, 201), (201, 200)]
    found = dict(tuple(r) for r in components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{i: 1 for i in [*range(1, 41), 300]}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# decontamination


def test_leaks_are_found_and_clean_texts_are_not(spark, odd, none):
    items = [(i, prose(9000 + i, 15 + i % 40)) for i in range(30)] + [(90, None), (91, ""), (92, "two words9"), (93, prose(9500, 200))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    r = random.Random(3)
    rows, wanted = [], set()
    for i in range(120):
        text = prose(i, r.randrange(5, 300)).split()
        if i % 4 == 0:
            item = i % 30
            at = r.randrange(len(text))
            text[at:at] = items[item][1].upper().split()
            wanted.add((i, item))
        rows.append((i, " ".join(text)))
    paraphrase = items[29][1].split()
    for k in range(0, len(paraphrase) - 12, 4):
        paraphrase[k] = f"changed{k}"
    rows += [(500, prose(1, 70) + " " + " ".join(paraphrase) + " " + prose(2, 70)), (501, "here two words9 stand"), (502, "two of words9"), (503, items[-1][1])]
    docs = odd.union(table(spark, [(10_000 + i, t) for i, t in rows]))
    found = decontamination.matches(docs, benchmark)
    pairs = {(r.doc_id - 10_000, r.item_id) for r in found.collect()}
    assert pairs == wanted | {(500, 29), (501, 92), (503, 93)}
    kept = decontamination.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - len({d for d, _ in pairs})
    assert decontamination.matches(none, benchmark).count() == 0
    assert decontamination.clean(docs, spark.createDataFrame([], "item_id long, text string")).count() == docs.count()


def test_common_subsequence():
    r = random.Random(1)
    for _ in range(50):
        a, b = ([r.randrange(6) for _ in range(r.randrange(1, 30))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for i in a:
            new = [0]
            for j, k in enumerate(b):
                new.append(row[j] + 1 if i == k else max(row[j + 1], new[-1]))
            row = new
        assert decontamination.common_words(np.array(a), np.array(b)) == row[-1]


# licences


def test_licence_places_and_labels(spark, odd, none):
    lines = ["Released under the MIT License.", "the Apache-License, version 2", "GNU GENERAL  public\nlicense", "mit licenses apache  licence", "All rights reserved", "MİT license Kit license", "Licensed under CC BY-NC 4.0.", "mit license mit license apache license"]
    docs = odd.union(table(spark, [(100 + i, f"{prose(i, i * 5)} {a} {b}") for i, (a, b) in enumerate(zip(lines, lines[1:] + lines[:1]))]))
    idf = licenses.frequencies(docs)
    found = licenses.summarise(licenses.scan(docs, idf, "doc_id", "text")).collect()
    for r in found:
        w = words(r.text)
        places = [(k, label) for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")) for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
        firsts = [k for k, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), min(firsts, default=None), max(firsts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        labels = {t.label for t in licenses.TEMPLATES for k in range(len(w)) if all(0 <= k + m < len(w) and w[k + m] == t.words[m] for m in t.mandatory) or (k == 0 and any(all(0 <= s + m < len(w) and w[s + m] == t.words[m] for m in t.mandatory) for s in range(-max(t.mandatory), 0)))}
        assert r.labels == ",".join(sorted(labels)) and 0 <= r.score <= 1 and (r.score > 0) == bool(labels)
    plan = licenses.scan(docs, idf, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
    assert licenses.summarise(licenses.scan(none, licenses.frequencies(none), "doc_id")).count() == 0


@pytest.mark.parametrize("gap,found", [(0, True), (3, True), (4, False)])
def test_licence_words_may_be_put_in_between_key_phrases(spark, gap, found):
    """A later key phrase may be three words off its place, whichever words are rare."""
    isc = "Permission to use, copy, modify, and/or distribute this software for any purpose {}with or without fee is hereby granted"
    cut = isc.replace("and/or ", "").replace("any ", "")  # two words fewer
    docs = table(spark, [(1, prose(1, 30) + " " + isc.format("whatsoever " * gap)), (2, cut.format("")), (3, isc.format("")[:60]), (4, "with or without fee is hereby granted " + isc.format("")[:60])])
    for idf in (licenses.frequencies(docs), dict.fromkeys(licenses.frequencies(docs), 1.0)):
        got = {r.doc_id: (r.labels, r.score) for r in licenses.summarise(licenses.scan(docs, idf, "doc_id")).collect()}
        assert (got[1][0] == "isc") == found and got[2][0] == "isc" and got[3] == got[4] == ("", 0.0)
        assert not found or gap or got[1][1] == pytest.approx(1.0)


@pytest.mark.parametrize("seed", range(3))
def test_licence_alignments_equal_brute_force(spark, seed):
    """Random mixtures of template words: every alignment that the rule allows, and no other."""
    r, rows = random.Random(seed), []
    for i in range(40):
        text = []
        for _ in range(r.randrange(1, 6)):
            own = list(r.choice(licenses.TEMPLATES).words)
            for _ in range(r.randrange(4)):
                own.insert(r.randrange(len(own) + 1), r.choice(["x", "the", own[0]])) if r.random() < 0.6 else own.pop(r.randrange(len(own))) if len(own) > 1 else None
            text += own
        rows.append((i, " ".join(text)))
    docs = table(spark, rows)
    idf = licenses.frequencies(docs)
    got = {x.doc_id: sorted((f.template, f.first) for f in x.found) for x in licenses.scan(docs, idf, "doc_id").collect()}
    for i, text in rows:
        w = words(text)
        at = lambda k: w[k] if 0 <= k < len(w) else None  # noqa: E731, B023
        wanted = []
        for n, t in enumerate(licenses.TEMPLATES):
            for first in range(-len(t.words), len(w)):
                near = [[0] if k == 0 else range(-t.slack, t.slack + 1) for k in range(len(t.phrases))]
                if all(any(all(at(first + d + p) == x for p, x in phrase) for d in near[k]) for k, phrase in enumerate(t.phrases)):
                    wanted.append((n, first))
        assert got[i] == wanted


def test_long_licence_text(spark):
    """A text that repeats a licence thousands of times is one row's work, in line with its length."""
    once = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files mit license "
    (row,) = licenses.summarise(licenses.scan(table(spark, [(1, once * 4000)]), dict.fromkeys(licenses.frequencies(table(spark, [(1, once)])), 1.0), "doc_id")).collect()
    assert (row.n_base, row.labels, row.last_word - row.first_word) == (4000, "mit", len(once.split()) * 3999)


# toxicity and quality


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=40))
def test_maximal_segments(scores):
    def wanted(low, high):
        """The best run, shortest first, then the same on either side of it."""
        runs = [(sum(scores[i:j]), -(j - i), -i, j) for i in range(low, high) for j in range(i + 1, high + 1)]
        if not runs or max(runs)[0] <= 0:
            return []
        total, _, start, end = max(runs)
        return wanted(low, -start) + [(-start, end, total)] + wanted(end, high)

    assert toxicity.segments([float(s) for s in scores]) == wanted(0, len(scores))


def labelled_rows(spark, n=400):
    r, rows, labels = random.Random(2), [], []
    for i in range(n):
        text, toxic = prose(i, r.randrange(5, 80)).split(), r.random() < 0.3
        if toxic:
            for _ in range(4):
                text[r.randrange(len(text))] = r.choice(["idiot", "moron", f"scumm{r.randrange(1000)}"])
        good = r.random() < 0.6
        rows.append((i, " ".join(text) if good else " | ".join(text).upper()))
        labels.append((i, int(toxic), int(good)))
    labels += [(0, None, None), (None, 1, 1), (3, labels[3][1], labels[3][2])]
    return table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def accuracy(found, labels, column):
    known = {r.doc_id: r[column] for r in labels.collect() if r[column] is not None}
    return np.mean([(r.score >= 0.5) == known[r.doc_id] for r in found if r.doc_id is not None and r.doc_id in known and r.doc_id % 4 == 0])


def test_toxicity(spark, odd, none):
    docs, labels = labelled_rows(spark)
    model = toxicity.fit(docs, labels.where("doc_id % 4 != 0 or doc_id is null"))
    found = toxicity.score(docs.union(odd.where("doc_id is null")), model, "doc_id").collect()
    assert accuracy(found, labels, "toxic") > 0.95 and all(0 <= r.score <= 1 for r in found)
    spans = toxicity.passages(docs, model)
    assert spans.count() > 0 and spans.where("expected >= 1 or first_word >= end_word").count() == 0
    assert toxicity.score(odd, model, "doc_id").count() == odd.count()
    kept = toxicity.reject(odd, model, 0.5)
    assert kept.columns == odd.columns and Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in odd.collect() if r.doc_id != 6)
    blank = toxicity.fit(docs, labels.where("false"))
    assert toxicity.score(docs, blank, "doc_id").agg(F.max("score")).first()[0] < 1e-9
    assert toxicity.score(none, toxicity.fit(none, labels), "doc_id").count() == 0


def test_surest_rows_come_from_all_documents_without_a_label(spark):
    """What the views teach equals a sort of all unlabelled rows, copies counted once."""
    docs, labels = labelled_rows(spark, 300)
    docs = docs.union(docs.where("doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 1000)).repartition(7)
    pool = quality.Pool(docs, labels.where("doc_id < 100").select("doc_id"))
    rows = pool.table.orderBy("key").dropDuplicates(["key"]).toArrow().sort_by("key")
    assert rows.num_rows == docs.where("doc_id >= 100").select("text").distinct().count()
    both, keys = quality._unpacked(rows), rows["key"].to_numpy()
    y = np.arange(len(keys)) % 2
    views = [quality.View.fit(x, y) for x in both]
    taught = [keys[::5], keys[::7]]
    found = pool.surest(views, (9, 4), taught)
    got = {(v, label): set() for v in (0, 1) for label in (0, 1)}
    for v, label, key in zip(*(found[c].to_pylist() for c in ("view", "label", "key"))):
        got[v, label].add(key)
    for v in (0, 1):
        logits = dict(zip(keys.tolist(), views[v].logits(both[v])))
        fresh = [k for k in logits if k not in set(taught[1 - v].tolist())]
        for label, count, sign in ((0, 9, -1), (1, 4, 1)):
            ranked = sorted((k for k in fresh if sign * logits[k] > 0), key=lambda k: -sign * logits[k])
            assert got[v, label] == set(ranked[:count])


def test_quality(spark, odd, none):
    docs, labels = labelled_rows(spark, 600)
    taught = labels.where("(doc_id % 4 != 0 and doc_id < 400) or doc_id is null")
    model = quality.fit(docs, taught)
    found = quality.score(docs, model, "doc_id").collect()
    assert accuracy(found, labels, "quality") > 0.95 and all(0 <= r.score <= 1 for r in found)
    assert quality.score(odd, model, "doc_id").count() == odd.count()
    assert {r.score for r in quality.score(odd, quality.fit(docs, labels.where("false")), "doc_id").collect()} == {0.5}
    assert quality.score(none, model, "doc_id").count() == 0 and quality.fit(none, labels).content is None


# neighbours


def test_neighbours(spark):
    r = np.random.default_rng(1)
    x = r.standard_normal((900, 16)).astype(np.float32) * r.uniform(0.5, 2, (900, 1)).astype(np.float32)
    x[100:160] = x[100]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [float("inf")] * 16), (2004, [1.0] * 3), (2005, [None] * 16), (None, [1.0] * 16), rows[7]]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    usable = neighbours.usable(vectors)
    assert usable.count() == 900
    index = neighbours.build_index(usable, k=10, shard_rows=300)
    assert index.count() == index.first()["shards"] > 1
    found = neighbours.search(index, usable.where("id % 20 = 0"), k=10, block_rows=20).collect()
    scores = x.astype(float) @ x.astype(float).T
    hit = 0
    for q in range(0, 900, 20):
        own = sorted((f.rank, f.vec_id, f.score) for f in found if f.query_id == q)
        assert [o[0] for o in own] == list(range(1, 11))
        assert all(s == pytest.approx(scores[q, v]) for _, v, s in own)
        assert own == sorted(own, key=lambda o: (-o[2], o[1]))
        wanted = sorted((c for c in range(900) if c != q), key=lambda c: (-round(scores[q, c], 9), c))[:10]
        hit += len(set(wanted) & {o[1] for o in own})
    assert hit / 450 > 0.9
    few = neighbours.usable(vectors.where("vec_id < 5"))
    assert neighbours.search(neighbours.build_index(few), few).count() == 20
    empty = neighbours.usable(vectors.where("false"))
    assert neighbours.search(neighbours.build_index(empty), empty).count() == 0


# derivatives


class Reader(html.parser.HTMLParser):
    HIDDEN = {"script", "style", "noscript", "template"}

    def __init__(self):
        super().__init__()
        self.text, self.depth = [], 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.HIDDEN
        self.text.append(" " if tag not in ("b", "a", "i", "span") else "")

    def handle_endtag(self, tag):
        self.depth -= tag in self.HIDDEN
        self.text.append(" " if tag not in ("b", "a", "i", "span") else "")

    def handle_data(self, data):
        if not self.depth:
            self.text.append(data)


def test_records_round_trip(spark):
    page = '<!DOCTYPE html><html><head><title>A &amp; b</title><style>p{}</style><script>var t="</p>";</script></head><body><p>One<br>two &lt;3&gt; <b>x</b>y</p><!-- no --><a href="/l">link</a></body></html>'
    rows = [(1, "http://a/1", page), (1, "http://a/1", page), (2, None, "<p>broken <b"), (3, "http://a/3", None), (None, "u", ""), (4, "http://a/4", "<script>open")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, kind string, block string")
    made = warc.derivatives(warc.responses(pages))
    found = made.withColumn("record", warc.serialise(made)).collect()
    sources = {r.record_id: r for r in warc.responses(pages).collect()}
    assert len(found) == 12 and Counter(r.kind for r in found) == {"metadata": 6, "conversion": 6}
    for r in found:
        header, _, rest = r.record.encode().partition(b"\r\n\r\n")
        lines = header.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        source = sources[r.refers_to]
        whole = source.http.encode() + source.payload.encode()
        assert lines[0] == "WARC/1.1" and fields["WARC-Type"] == r.kind
        assert rest == r.block.encode() + b"\r\n\r\n" and int(fields["Content-Length"]) == len(r.block.encode())
        assert fields["WARC-Refers-To"] == f"<{r.refers_to}>" and fields.get("WARC-Target-URI") == r.target_uri
        assert fields["WARC-Block-Digest"] == warc.digest(r.block.encode())
        assert (r.source_block_digest, r.source_payload_digest) == (warc.digest(whole), warc.digest(source.payload.encode()))
        assert (r.concurrent_to == r.refers_to) == (r.kind == "metadata") and r.source_http == source.http
    by = {(r.page_id, r.kind): r.block for r in found}
    assert by[1, "conversion"] == "A & b\nOne\ntwo <3> xy\nlink"
    assert "title: A & b\r\n" in by[1, "metadata"] and "outlink: /l L a/@href\r\n" in by[1, "metadata"] and "http-status: 200" in by[1, "metadata"]
    assert by[2, "conversion"] == "broken <b" and by[3, "conversion"] == "" and by[4, "conversion"] == ""


def test_text_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = warc.derivatives(warc.responses(pages)).where("kind = 'conversion'").join(pages, "page_id")
    for r in found.select("html", "block").collect():
        reader = Reader()
        reader.feed(r.html)
        reader.close()
        assert r.block.split() == "".join(reader.text).split()
    assert warc.derivatives(warc.responses(pages.where("false"))).count() == 0


def test_a_model_without_some_of_its_files_is_refused(spark):
    import os

    docs = table(spark, [(i, prose(i, 60)) for i in range(6)])
    model = ngrams.fit(docs)
    assert model.pairs and model.words
    found = ngrams.Maps(model.folder, model.shards, model.pairs, model.words)
    assert sum(len(s["key"]) for s in found.words if s) == model.words
    os.rename(f"{model.folder}/words-0.key", f"{model.folder}/words-0.away")
    with pytest.raises(ngrams.MissingFiles):
        ngrams.Maps(model.folder, model.shards, model.pairs, model.words)
    with pytest.raises(Exception, match="spark.checkpoint.dir has to be a folder"):
        ngrams.score(docs, model, "doc_id").collect()
