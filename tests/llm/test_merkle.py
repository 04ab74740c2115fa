"""The Merkle manifest against a plain recursive version."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from affinity.llm import merkle_manifest
from affinity.llm.merkle_manifest import build_manifest, tampered_proofs

from llm_data import ODD, docs_of  # noqa: F401


def H(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    said = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return H(*["-" if v is None else f"{len(v.encode())}:{v}" for v in said])


def climb(nodes):
    """The root of ``nodes`` and, for each, its steps (sibling or None, sibling stands left)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            path.append((nodes[i ^ 1] if i ^ 1 < len(nodes) else None, i % 2 == 1))
        nodes = [H(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return nodes[0], paths


def plain(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        built[g] = climb([leaf(*r) for r in groups[g]])
    root, above = climb([built[g][0] for g in order])
    out = []
    for g, top in zip(order, above):
        for r, path in zip(groups[g], built[g][1]):
            steps = path + top
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            at = leaf(*r[:3], r[3] + 1, r[4]) if changed else leaf(*r)
            for other, left in steps:
                at = H(at) if other is None else H(other, at) if left else H(at, other)
            out.append((r[0], leaf(*r), built[g][0], root, H(*[s for s, _ in steps if s]), at, at == root))
            assert (at == root) != changed
    return Counter(out)


def found(df):
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


@pytest.mark.parametrize("step", [1, 3, 8])
def test_equals_the_plain_version_at_every_size_of_a_tree(docs_of, monkeypatch, step):
    monkeypatch.setattr(merkle_manifest, "STEP", step)
    rows, i = [], 0
    for g, size in (("a", 1), ("b", 2), ("c", 3), ("", 4), ("é", 7), (None, 8), ("z", 9), ("d", 33), ("e", 64), ("f", 65)):
        for _ in range(size):
            i += 1
            rows.append(((i * 37) % 1009, f"text {i}", g, "src"))
    docs = docs_of(rows)
    assert found(tampered_proofs(docs)) == plain([(r[0], r[3], r[2], len(r[1]), r[1]) for r in rows])


def test_odd_rows(docs_of):
    rows = [(i, t, g, s) for (i, t), g, s in zip(ODD, ["en", None, "", "en"] * 3, [None, "", "s"] * 4)] + [(4, "one", "en", None)] * 3
    got = found(tampered_proofs(docs_of(rows)))
    assert got == plain([(i, s, g, len(t or ""), t) for i, t, g, s in rows])
    assert tampered_proofs(docs_of([])).count() == 0
    one = found(tampered_proofs(docs_of([(7, None, None, None)])))
    assert one == plain([(7, None, None, 0, None)])
    # null n_chars stays null: nothing to change
    blank = docs_of([(x, "t") for x in range(40)]).selectExpr("doc_id", "text", "lang", "source", "cast(null as bigint) n_chars")
    assert all(r.verified for r in tampered_proofs(blank).collect())


def test_only_every_step_is_stored_and_proofs_hold(spark):
    rows = spark.range(1000).selectExpr("id", "id % 2 as g", "sha2(cast(id as string), 256) as leaf")
    made = build_manifest(rows, "g", ["id"])
    assert [t.count() for t in made.groups.levels] == [4, 2]
    proofs = made.proofs()
    assert proofs.where(merkle_manifest.folded(proofs.leaf, proofs.path) != proofs.root).count() == 0
    assert proofs.select("root").distinct().collect()[0].root == made.root()
    assert build_manifest(rows.limit(0), "g", ["id"]).root() is None
