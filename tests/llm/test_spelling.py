"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from affinity.llm.spelling_fm import Index, near_pairs, spelling_forms, text_words

from llm_data import ODD, docs_of  # noqa: F401


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_words(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def plain_forms(rows):
    n = plain_words(rows)
    beside = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(beside[w]), form[w] and n[form[w]]))
    return out


@given(st.sets(st.text(alphabet="abé", min_size=1, max_size=6), min_size=1, max_size=40), st.integers(0, 3), st.data())
@settings(max_examples=300, deadline=None)
def test_index_equals_all_pairs(words, half, data):
    """Also with letters that no word of the index has, and halves of any length."""
    queries = [*words, *data.draw(st.lists(st.text(alphabet="abéz", min_size=1, max_size=6), max_size=10))]
    index = Index(list(words))
    halves = [min(half, len(q)) for q in queries]
    a, b = index.one_error_behind(queries, halves)
    got = Counter((queries[x], index.words[y], x) for x, y in zip(a.tolist(), b.tolist()))
    want = Counter()
    for x, (q, h) in enumerate(zip(queries, halves)):
        for w in words:
            if w[:h] == q[:h] and near(q[h:], w[h:]):
                want[q, w, x] += 1
    assert got == want


@pytest.mark.parametrize("index_words", [1, 7, 4096])
def test_pairs_over_many_indexes_equal_all_pairs(spark, index_words):
    """Halves shared by many words reach over several indexes; no pair is lost or found twice."""
    rng = random.Random(index_words)
    base = ["aaaaaaa", "aaaaaaaa", "aaaaaab", "baaaaaa", "abababa", "éabcdefg", "straßen"] + ["pre" + "".join(rng.choice("ab") for _ in range(6)) for _ in range(40)]
    words = set(base)
    for w in base:
        for _ in range(4):
            i = rng.randrange(len(w) + 1)
            words |= {w[:i] + rng.choice("abé") + w[i:], w[:i] + rng.choice("abz") + w[i + 1:], w[:i] + w[i + 1:]}
    words = {w for w in words if len(w) >= 7}
    vocab = spark.createDataFrame([(w, i + 2) for i, w in enumerate(sorted(words))], "word string, n bigint")
    got = Counter((r.word, r.near) for r in near_pairs(vocab, index_words).collect())
    assert got == Counter((a, b) for a in words for b in words if near(a, b))


def test_forms_equal_brute_force_on_the_documents(spark, docs_of):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(900_000 + i, t) for i, t in ODD if i is not None]
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_forms(docs_of(rows)).collect()}
    assert got == plain_forms(rows)
    assert any(f for _, f, *_ in got)


def test_chains_ties_and_odd_rows(docs_of):
    """Forms in a chain of three steps, ties of count, words at the limits of length and count, null ids and texts."""
    text = ("chainedword " * 2000 + "chainedwor " * 200 + "chainedworx " * 20 + "chaineworx " * 2 + "TIEDWORDa " * 30 + "tiedwordb " * 30
            + "tiedword tiedword seventy seventy sixsix sixsix oncewritten Überzug Überzug überzug überzug")
    rows = [(17, text), (None, text), (17, text), (3, None), (4, ""), (5, "x×y÷zÿÀ x×y÷zÿÀ")]
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_forms(docs_of(rows)).collect()}
    assert got == plain_forms(rows)
    assert spelling_forms(docs_of([])).count() == 0 == spelling_forms(docs_of([(1, "no long ones"), (2, None)])).count()
    assert text_words(None, None) == Counter()
