"""Token counts, BPE, URL filter and HTML extraction."""

import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from affinity.llm.bpe_backtrack import BacktrackBpe, encode_documents
from affinity.llm.html_mincut import BlockClassifier, SLOTS, blocks_of, extract_main_text, min_cut
from affinity.llm.token_cache import Counter as TokenCounter
from affinity.llm.token_cache import read_cache, token_counts, tokenizer_digest
from affinity.llm.url_markov import BACK_OFF, ORDER, MarkovPair, _slots, calibrate, judge_urls, with_scores
from affinity.session import checkpoint_dir

from llm_data import ODD, docs_of  # noqa: F401

WORD_BPE, BYTE_BPE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = st.sampled_from(["a", "e", "th", "ing", "ation", " ", "'s", "'re", "\n", "É", "ß", "Σ", "ΑΣ", "İ", "1", "$$$", "!!", "中",
                          "e\u0301", "\x00", "  ", "aaaaaaa", "<|endoftext|>", "<|startoftext|>", "<|", "😀", "ՙ", "\u200d", "\x85"])


@pytest.fixture(scope="module")
def libraries():
    return {p: Tokenizer.from_file(p) for p in (WORD_BPE, BYTE_BPE)}


@pytest.fixture(scope="module")
def bpe():
    return BacktrackBpe(WORD_BPE)


@given(st.one_of(st.lists(PIECES, max_size=20).map("".join), st.text(max_size=40)))
@settings(max_examples=600, deadline=None)
def test_backtracking_equals_the_library(bpe, libraries, text):
    want = libraries[WORD_BPE].encode(text, add_special_tokens=False).ids
    got = bpe.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == want
    assert b"".join(bpe.decode(got)).decode() == libraries[WORD_BPE].decode(want, skip_special_tokens=False)


def test_backtracking_has_to_take_tokens_back(bpe):
    """On words of few letters the longest match is often wrong; merging is the judge."""
    for letters in ("aeht", "ino", "stre"):
        for word in map("".join, itertools.product(letters, repeat=6)):
            assert bpe.encode_word(word) == bpe.merged(word + "\uffff")


def test_documents_encode_and_decode_as_the_library(spark, docs_of, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + ODD
    got = Counter()
    for r in encode_documents(docs_of(rows), WORD_BPE).collect():
        assert len(r.ids) == r.n_tokens and hashlib.sha256(r.decoded.encode()).hexdigest() == r.decoded_sha256
        got[r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256] += 1
    want = Counter()
    for i, t in rows:
        ids = libraries[WORD_BPE].encode(t or "", add_special_tokens=False).ids
        text = libraries[WORD_BPE].decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert got == want
    assert encode_documents(docs_of([]), WORD_BPE, ids=False, decoded=False).count() == 0


@given(st.one_of(st.lists(PIECES, max_size=20).map("".join), st.text(max_size=40)))
@settings(max_examples=400, deadline=None)
def test_fast_counts_equal_the_library(libraries, text):
    global _counter
    _counter = globals().get("_counter") or TokenCounter(BYTE_BPE, RANKS)
    assert _counter.count(text) == len(libraries[BYTE_BPE].encode(text, add_special_tokens=False).ids)


def test_token_cache_encodes_only_what_it_lacks(spark, docs_of, libraries, tmp_path):
    path = f"{checkpoint_dir(spark)}/cache-{tmp_path.name}"
    version = tokenizer_digest(BYTE_BPE)
    want = Counter((i, len((t or "").encode()), n := len(libraries[BYTE_BPE].encode(t or "", add_special_tokens=False).ids), n > 1024)
                   for i, t in ODD)
    assert Counter(map(tuple, token_counts(docs_of(ODD), path, BYTE_BPE, RANKS).collect())) == want
    size = spark.read.parquet(path).count()
    assert size == read_cache(spark, path, version).count() == len({t or "" for _, t in ODD})
    # a second call adds nothing; a planted count shows that stored counts are used
    assert Counter(map(tuple, token_counts(docs_of(ODD), path, BYTE_BPE, RANKS).collect())) == want
    assert spark.read.parquet(path).count() == size
    new = "never seen before"
    spark.createDataFrame([(version, hashlib.sha256(new.encode()).hexdigest(), 77), ("other", "x", 1)],
                          "tokenizer string, content string, n_tokens bigint").write.mode("append").parquet(path)
    assert token_counts(docs_of([(1, new)]), path, BYTE_BPE, RANKS).first().n_tokens == 77
    assert token_counts(docs_of([]), path, BYTE_BPE, RANKS).count() == 0


URLS = [None, "", "nothing", "http://", "http://a.org", "http://a.org/", "HTTPS://Blog.Example.ORG/es/1?q#f", "http://example.org/en/1",
        "http://example.org/en/2", "x://org/", "x://notorg/", "x://com/fr/", "x://a.com/de/x", "x://a.com/DE/", "x://u@a.com:80/fr/é",
        "x://example.org?/es/", "x://ÉÀ.net/p#x", "a://b.com/fr/://c.org/"]


def plain_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    host, slash, path = rest[:cut].partition("/")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = slash + path
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    fits = [r for r in rules for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    rule = max(fits, key=len, default=None)
    return host, path, rule, rules.get(rule)


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(URLS)] + [(None, URLS[5], "x", "x")] * 2,
                                  "page_id bigint, url string, rule string, score string")
    rows = judge_urls(pages).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        url = URLS[5] if r.page_id is None else URLS[r.page_id]
        host, path, rule, said = plain_rule(url)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert said is None or r.verdict == said
    assert judge_urls(pages.limit(0)).count() == 0


def test_markov_score_equals_its_definition():
    """The hashed tables against dictionaries of grams and contexts, on few urls (no collisions)."""
    urls = {1: [b"abcabc", b"abd"], 0: [b"xyz", b"xxabc"]}
    shape = (2, ORDER + 1, 1 << 15)
    model = MarkovPair(np.zeros(shape), np.zeros(shape))
    grams, contexts = Counter(), Counter()
    for c, texts in urls.items():
        _, g, h = _slots(texts)
        for k in range(ORDER + 1):
            np.add.at(model.grams[c, k], g[k], 1)
            np.add.at(model.contexts[c, k], h[k], 1)
        for t in texts:
            padded = b"\0" * ORDER + t
            for i, k in itertools.product(range(ORDER, len(padded)), range(ORDER + 1)):
                grams[c, k, padded[i - k:i + 1]] += 1
                contexts[c, k, padded[i - k:i]] += 1

    def log_p(c, t):
        padded, total = b"\0" * ORDER + t, 0.0
        for i in range(ORDER, len(padded)):
            p = 1 / 256
            for k in range(ORDER + 1):
                p = (grams[c, k, padded[i - k:i + 1]] + BACK_OFF * p) / (contexts[c, k, padded[i - k:i]] + BACK_OFF)
            total += math.log(p)
        return total

    tests = [b"abc", b"xyzabc", b"q", b""]
    want = [(log_p(1, t) - log_p(0, t)) / max(1, len(t)) for t in tests]
    np.testing.assert_allclose(model.score(tests), want, rtol=1e-6, atol=1e-9)


def test_url_scores_are_exact_beyond_the_hashed_slots(spark):
    """More distinct grams than the hashed tables have slots: the scores equal those of exact dictionaries."""
    rng = random.Random(3)
    urls = [f"h{i}.{('org/', 'com/de/')[i % 2]}" + "".join(rng.choices("abcdefghij" if i % 3 else "klmnop0123", k=30)) for i in range(2500)]
    rows = [(i, u, i % 7, 1 - i % 2) for i, u in enumerate(urls + urls[:9])]
    got = {r.id: r.score for r in with_scores(spark.createDataFrame(rows, "id int, url string, fold int, label int")).collect()}
    grams, contexts = Counter(), Counter()
    for _, u, fold, c in rows:
        padded = b"\0" * ORDER + u.encode()
        for i, k in itertools.product(range(ORDER, len(padded)), range(ORDER + 1)) if fold else ():
            grams[c, k, padded[i - k:i + 1]] += 1
            contexts[c, k, padded[i - k:i]] += 1
    assert sum(1 for _, k, _ in grams if k == ORDER) > 1 << 15 and len(got) == len(rows)
    for i, u, _, _ in rows[::50]:
        padded, total = b"\0" * ORDER + u.encode(), 0.0
        for j, c in itertools.product(range(ORDER, len(padded)), (0, 1)):
            p = 1 / 256
            for k in range(ORDER + 1):
                p = (grams[c, k, padded[j - k:j + 1]] + BACK_OFF * p) / (contexts[c, k, padded[j - k:j]] + BACK_OFF)
            total += (2 * c - 1) * math.log(p)
        assert abs(got[i] - total / len(u)) < 1e-9


def test_url_model_separates_and_calibrates(spark):
    rows = judge_urls(spark.read.parquet("/root/testdata/sf0.1/pages.parquet")).collect()
    told = [(r.score, r.rule) for r in rows if r.rule]
    right = [(s >= 0) == (rule in ("org/", "com/fr/")) for s, rule in told]
    assert np.mean(right) > 0.95 and {r.verdict for r in rows if r.rule is None} == {"allow", "block"}
    scored = spark.createDataFrame([(0, -1.0), (0, 0.4), (1, 0.6), (1, 2.0)], "label int, score double")
    assert 0.4 < calibrate(scored) <= 0.6 and calibrate(scored.where("label = 1")) == 0.0


@given(st.integers(1, 7).flatmap(lambda n: st.tuples(
    st.lists(st.integers(0, 9), min_size=n, max_size=n), st.lists(st.integers(0, 9), min_size=n, max_size=n),
    st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(0, 6)), max_size=10))))
@settings(max_examples=400, deadline=None)
def test_min_cut_equals_brute_force(case):
    content, boiler, edges = case

    def cost(side):
        return (sum(b if s else c for s, c, b in zip(side, content, boiler)) + sum(w for i, j, w in edges if side[i] != side[j]))
    assert cost(min_cut(content, boiler, edges)) == min(map(cost, itertools.product((False, True), repeat=len(content))))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy now, buy cheap.</div><article><h1>Head&amp;line</h1><p>First <b>bo</b>ld,\n text&nbsp;here.<br>More of it, and more.
<p>Second paragraph &lt;ok&gt; with some words in it.</p></article><aside>See also</aside><form>Name <input></form>
<section class="comments"><p>Great article, thanks for it, really.</p></section><footer>&copy; us</footer></body></html>"""


def test_extraction_of_a_page_and_odd_pages(spark):
    html = [PAGE, None, "", "<", "<p", "<script>x", PAGE[:PAGE.index("Second") + 9], "a &am", "<div>" * 3000 + "</p>" * 3000, "<a title=don't>x</a><b class='"]
    pages = spark.createDataFrame([(i, "u", h, "x") for i, h in enumerate(html)] + [(0, None, PAGE, "x")] * 20 + [(None, "u", PAGE, "x")],
                                  "page_id bigint, url string, html string, text string")
    rows = extract_main_text(pages).collect()
    main = "Head&line First bold, text here. More of it, and more. Second paragraph <ok> with some words in it."
    assert len(rows) == len(html) + 21
    for r in rows:
        assert r.n_chars == len(r.text) and r.text == " ".join(r.blocks)
        if r.page_id in (0, None):
            assert r.text == main
        elif r.page_id in (1, 2):
            assert r.text == ""
        elif r.page_id == 6:
            assert r.text == main[:main.index("Second") + 6] + " pa"
    assert extract_main_text(pages.limit(0)).count() == 0
    assert BlockClassifier.from_counts(np.zeros((2, SLOTS + 1))).extract(PAGE) == [
        "Head&line", "First bold, text here. More of it, and more.", "Second paragraph <ok> with some words in it."]


def test_names_of_the_elements_around_the_article_do_not_doom_it(spark):
    """Wrappers, the page and the article itself may be named after other parts; comments and menus stay out."""
    main = "Head&line First bold, text here. More of it, and more. Second paragraph <ok> with some words in it."
    odd = [PAGE.replace("<body>", '<body class="has-sidebar">'), PAGE.replace("<article>", '<article class="legal-news">'),
           PAGE.replace("<article>", '<div id="search-layout"><div class=widgets><article>').replace("</article>", "</article></div></div>"),
           PAGE.replace("<article>", "<main class='share'><article>").replace("</footer>", "</footer></main>"),
           PAGE.replace('<section class="comments"><p>', '<section class="comments"><article><p>').replace("</p></section>", "</p></article></section>"),
           PAGE.replace("<html>", '<html id="newsletter">')]
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(odd)] + [(100 + i, "u", PAGE) for i in range(20)],
                                  "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    assert set(got.values()) == {main}
    assert [b.text for b in blocks_of("<article><p>Let <math><mi>x</mi></math> be.</p></article>")] == ["Let x be."]


def test_blocks_keep_all_text_outside_skipped_elements():
    assert [b.text for b in blocks_of("a<div>b<span>c</span> d<p>e<p>f</div>g<ul><li>h<li>i</ul>&amp;")] == \
        ["a", "bc d", "e", "f", "g", "h", "i", "&"]


def test_long_pages_of_one_kind_take_linear_work():
    """Quadratic work would take minutes here."""
    model = BlockClassifier(np.zeros(SLOTS), 0.0)
    items = [f"Some words here {i}." for i in range(40_000)]
    article = "".join(f"<p>{x}</p>" for x in items)
    assert model.extract(f"<article>{article}</article>") == items
    assert model.extract(f"<nav>{article}</nav><article>{article}</article>") == items
    unended = "".join(f"<button><p>{x}" for x in items)
    assert [b.text for b in blocks_of(unended)] == items


def test_extraction_equals_the_article_on_the_pages(spark):
    from html import unescape
    import re
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract_main_text(pages, with_blocks=False).collect()}
    for r in pages.collect():
        article = re.split("</article>", r.html[r.html.index("<article>"):])[0]
        assert got[r.page_id] == " ".join(unescape(re.sub("<[^>]*>", "", re.sub("</?(?:p|h1|br)>", " ", article))).split())
