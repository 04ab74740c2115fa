"""Exact and near duplicates, and substring dedup, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from affinity.llm.components import connected_components
from affinity.llm.exact_dedup import drop_exact_copies, exact_dedup
from affinity.llm.phrase_automata import WINDOW, remove_phrases
from affinity.llm.simhash_ball import drop_near_copies, fingerprint, simhash_components

from llm_data import ODD, docs_of  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def plain_simhash(text):
    """The fingerprint by its definition."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams)) if grams else 0


def plain_removal(texts):
    """(n_words, n_removed, kept_sha256) of every text by counting all windows."""
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + WINDOW]) for w in words for i in range(len(w) - WINDOW + 1))
    out = []
    for w in words:
        cut = {k for i in range(len(w) - WINDOW + 1) if seen[tuple(w[i:i + WINDOW])] > 1 for k in range(i, i + WINDOW)}
        out.append((len(w), len(cut), sha(" ".join(x for k, x in enumerate(w) if k not in cut))))
    return out


def test_exact_odd_rows(docs_of):
    rows = exact_dedup(docs_of(ODD)).collect()
    groups = defaultdict(list)
    for i, t in ODD:
        groups[t or ""].append(i)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256, r.copies) for r in rows)
    want = Counter()
    for i, t in set(ODD):
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        want[i, keep, len(ids), i == keep, sha(t or ""), ODD.count((i, t))] += 1
    # (None, None) and (None, "") would be one document: the fixture has one of them only
    assert got == want


def test_exact_drop_keeps_one_row_of_each_text(docs_of):
    docs = docs_of(ODD)
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len({t or "" for _, t in ODD}) == len({t or "" for _, t in rows})
    assert (5, "one") in rows and drop_exact_copies(docs.limit(0)).count() == 0 == exact_dedup(docs.limit(0)).count()


@pytest.mark.parametrize("support", [1 / 2, 1 / 1024])
def test_exact_result_does_not_depend_on_the_sketch(docs_of, support):
    rows = [(i, f"t{min(i % 50, 30)}") for i in range(3000)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup(docs_of(rows), support=support).collect()}
    last = {t: i for i, t in rows}
    size = Counter(t for _, t in rows)
    assert got == {i: (last[t], size[t]) for i, t in rows}


@given(st.text(alphabet="abAB É\n\t\x0b", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint_equals_its_definition(text):
    assert fingerprint(text) % (1 << 64) == plain_simhash(text)


def test_simhash_components_equal_brute_force(spark, docs_of):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = docs + [(10_000 + i, t) for i, t in ODD if i is not None and i != 4] + [(20_000, "one"), (20_001, "one")]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_components(docs_of(rows)).collect()}
    prints = {i: plain_simhash(t) for i, t in rows}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {i: (f"{prints[i]:016x}", find(i)) for i in ids}
    kept = {r.doc_id for r in drop_near_copies(docs_of(rows)).collect()}
    assert kept == {find(i) for i in ids}


def test_near_copies_are_told_apart_by_id_and_text(docs_of):
    """A repeated id with an unrelated text stays; of rows that share the smallest id one stays; null ids are rows."""
    rng = random.Random(3)
    a, b, c = (" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(200)) for _ in range(3))
    rows = [(3, a), (5, a + " "), (5, b), (5, b), (9, b.upper()), (None, c), (None, c), (None, "  " + a), (11, c + "\n")]
    kept = drop_near_copies(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(3, a), (5, b), (11, c + "\n")])
    alone = Counter((r.doc_id, r.text) for r in drop_near_copies(docs_of([(None, a), (None, b), (None, b), (1, None), (2, "")])).collect())
    assert alone == Counter([(None, a), (None, b), (1, None)])


def test_near_copies_odd_and_empty(docs_of):
    rows = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash_components(docs_of(ODD)).collect()}
    assert {(1, "0" * 16, 1), (2, "0" * 16, 1), (3, "0" * 16, 1), (None, "0" * 16, 1)} <= rows
    assert simhash_components(docs_of([])).count() == 0 == drop_near_copies(docs_of([])).count()


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 200)] + [(7, 7), (301, 300), (300, 301)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{100 + i: 100 for i in range(200)}, 300: 300, 301: 300}


def test_phrases_equal_brute_force_on_the_documents(spark, docs_of):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_phrases(docs_of(rows)).collect()}
    assert got == dict(zip([i for i, _ in rows], plain_removal([t for _, t in rows])))
    assert sum(n for _, n, _ in got.values()) > 0


def test_phrases_at_every_boundary(docs_of):
    """Windows that start and end at text ends, overlap, repeat inside one text, or are one word short."""
    w = [f"w{i}" for i in range(400)]
    texts = [w[:35], w[:36], w[1:36], w[40:74], w[30:80], w[200:300] + w[220:270], ["a"] * 35, ["b"] * 36, ["c"] * 90,
             w[300:334], w[290:335], (w[350:360] * 12), w[100:140], w[100:140], []]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = remove_phrases(docs_of(rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == dict(enumerate(plain_removal([t for _, t in rows])))
    for r in found:
        cut = {k for s in r.spans for k in range(s["start"], s["end"])}
        assert len(cut) == r.n_removed and r.kept == " ".join(x for k, x in enumerate(texts[r.doc_id]) if k not in cut)


def test_phrases_odd_rows(docs_of):
    long = " ".join(f"v{i}" for i in range(60))
    rows = [*ODD, (4, long), (4, long), (None, long + " tail"), (50, "\x0b".join(long.split()))]
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in remove_phrases(docs_of(rows)).collect())
    assert got == Counter((i, *x) for (i, _), x in zip(rows, plain_removal([t for _, t in rows])))
    assert remove_phrases(docs_of([])).count() == 0
