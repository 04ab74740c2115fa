"""Winnowing against its definition, its guarantee, and the comparison with edited texts in one list."""

import hashlib
import random
from collections import Counter

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from affinity.llm import winnowing
from affinity.llm.winnowing import GUARANTEE, as_text, compare_with_edits, fingerprint_documents, likeness, winnow

from llm_data import ODD, docs_of  # noqa: F401

M = (1 << 64) - 1


def plain(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
    """(hash, position) pairs: the rightmost smallest hash of every window."""
    text = text or ""
    if not text:
        return []
    gram = min(gram, len(text))
    hashes = []
    for i in range(len(text) - gram + 1):
        h = 0
        for c in text[i:i + gram]:
            h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) & M
        h = ((h ^ h >> 33) * 0xFF51AFD7ED558CCD) & M
        h = ((h ^ h >> 29) * 0xC4CEB9FE1A85EC53) & M
        hashes.append(h >> 20)
    chosen = set()
    for i in range(max(1, len(hashes) - window + 1)):
        part = hashes[i:i + window]
        chosen.add(i + max(j for j, h in enumerate(part) if h == min(part)))
    return [(hashes[i], i) for i in sorted(chosen)]


def pairs(text, *size):
    return list(zip(*(x.tolist() for x in winnow(text, *size))))


@given(st.text(alphabet="ab é😀\n", max_size=120), st.integers(1, 9), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_equals_its_definition(text, gram, window):
    assert pairs(text, gram, window) == plain(text, gram, window)


@pytest.mark.parametrize("places", [6, 7])
def test_chunks_do_not_show(monkeypatch, places):
    """Chunks of 64 and 128 grams choose what one pass chooses, with ties across the chunks' ends."""
    rng = random.Random(1)
    texts = ["x" * 700, "".join(rng.choice("ab") for _ in range(900)), "ab" * 400, "".join(chr(rng.randrange(32, 900)) for _ in range(1000))]
    whole = [[p for _, p in pairs(t, 5, 9)] for t in texts]
    monkeypatch.setattr(winnowing, "_CHUNK", 1 << places)
    assert [[p for _, p in pairs(t, 5, 9)] for t in texts] == whole == [[p for _, p in plain(t, 5, 9)] for t in texts]


def test_a_shared_passage_of_the_guaranteed_length_is_never_missed():
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for _ in range(300):
        shared = word(GUARANTEE)
        a, b = word(rng.randrange(300)) + shared + word(rng.randrange(300)), word(rng.randrange(300)) + shared + word(rng.randrange(300))
        x, y = dict(pairs(a)), dict(pairs(b))
        common = x.keys() & y.keys()
        assert common and any(a[x[h]:x[h] + winnowing.GRAM] == b[y[h]:y[h] + winnowing.GRAM] for h in common)


def expected(rows):
    """The comparison of (doc_id, text) rows in one sorted list."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), xxhash_of(r[1])))
    out = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, changed, nxt = ([h for h, _ in plain(t)] if len(t) < 5000 else winnow(t)[0].tolist() for t in (text, edited, after))
        say = lambda hs: "".join(f"{h:011x}" for h in hs)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), say(own), say(changed), near(own, changed), near(own, nxt)))
    return Counter(out)


def xxhash_of(text):
    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def near(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("ranges", [1, 5, None])
def test_comparison_equals_one_sorted_list(spark, docs_of, ranges):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    rows = docs + [(i if i is None else 10_000 + i, t) for i, t in ODD] + [(20_000, "tail " * 30), (None, "another without id")]
    assert Counter(tuple(r) for r in compare_with_edits(docs_of(rows), ranges=ranges).collect()) == expected(rows)


def test_small_tables(docs_of):
    assert compare_with_edits(docs_of([])).count() == 0 == fingerprint_documents(docs_of([])).count()
    for rows in ([(1, "alone " * 40)], [(1, None)], [(2, "b" * 100), (1, None)], [(3, "same")] * 4):
        assert Counter(tuple(r) for r in compare_with_edits(docs_of(rows)).collect()) == expected(rows)


def test_fingerprints_of_odd_rows(docs_of):
    got = Counter((r.doc_id, *map(tuple, (r.hashes, r.positions))) for r in fingerprint_documents(docs_of(ODD)).collect())
    assert got == Counter((i, *(tuple(x.tolist()) for x in winnow(t))) for i, t in ODD)
    assert as_text(winnow("")[0]) == "" and len(as_text(winnow("word")[0])) == 11
    assert likeness(winnow("a")[0], winnow("")[0]) == 0 and likeness(winnow("")[0], winnow("")[0]) == 1
