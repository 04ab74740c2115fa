"""The pipeline against its stages' rules, and the registration of the queries."""

import itertools

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from affinity.llm import queries
from affinity.llm.quality_qda import quality_scores

from test_dedup import plain_simhash

SF = "/root/testdata/sf0.01"
DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_one_query_for_each_operator():
    names = sorted(queries.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, len(names) + 1)) and len(names) >= 10
    assert set(queries.oracle_sql()) <= set(names) and {*names, "pipeline"} <= set(entry.queries())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def smallest_of_near_copies(prints):
    """The smallest id of every component of fingerprints linked at 2 or fewer differing bits, by all pairs."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {find(i) for i in prints}


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = docs
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen, SF)
        rows = {r.doc_id: r for r in out.collect()}
        assert len(rows) <= seen.count()
        if name != "encoding":
            assert out.columns == DOCS
            seen = spark.createDataFrame(list(rows.values()), docs.schema).repartition(4)
        outs.append(rows)
    text = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in quality_scores(docs, labels).where("score >= 0.5").collect()}
    assert outs[0].keys() == good
    last = {}
    for i in sorted(good):
        last[text[i]] = i
    assert outs[1].keys() == set(last.values())
    assert outs[2].keys() == smallest_of_near_copies({i: plain_simhash(text[i]) for i in outs[1]})
    assert outs[3].keys() <= outs[2].keys() and len(outs[3]) > 0.4 * len(outs[2])
    assert all(outs[3][i].text == text[i] for i in outs[3])
    assert outs[4].keys() == outs[3].keys() and all(len(r.ids) == r.n_tokens for r in outs[4].values())
    whole = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {i: (r.n_tokens, r.ids_sha256) for i, r in outs[4].items()}
    assert np.mean([len(r.ids) for r in outs[4].values()]) > 10


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0 and (name == "encoding" or out.columns == DOCS)
