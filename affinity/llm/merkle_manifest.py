"""Merkle manifest of a table by checkpoint and recompute.

Rows are the leaves of one binary tree per group, the groups' roots the leaves
of a tree above them. Of a tree only every STEP-th level is stored, as rows of
aligned subtrees: (tree, block, n, members), at most 2 ** STEP members in
order. A proof regenerates the levels between from the stored members below
them, emits the siblings of every member and forgets the rest.

Leaves get their positions from a range partitioning and per-partition offsets,
so no tree is ever sorted or counted in one task, however large. All work is
DataFrame expressions; the loops are over stored levels, not over data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import bound, stored

#: levels from one stored level to the next; a block has 2 ** STEP members at most
STEP = 8


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon and the value as text: no two lists of fields read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _height(n: Column) -> Column:
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _rounds(base: int) -> Column:
    """Levels that a block whose members are on level ``base`` still has above it, STEP at most."""
    return F.greatest(F.lit(0), F.least(F.lit(STEP), _height(F.col("n")) - base))


def _paired(level: Column) -> Column:
    """The level above: the digest of every two neighbours, and of a last one alone."""
    return F.transform(F.sequence(F.lit(0), F.shiftright(F.size(level) - 1, 1)), lambda i: F.sha2(
        F.concat(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit(""))), 256))


def _each_round(rounds: Column) -> Column:
    return F.slice(F.array(*[F.lit(i) for i in range(STEP)]), F.lit(1), rounds)


def _levels(base: int) -> Column:
    """All levels of a block, its members' digests first and its root last."""
    return F.aggregate(_each_round(_rounds(base)), F.array(F.transform("members", lambda m: m["digest"])),
                       lambda found, _: F.concat(found, F.array(_paired(F.element_at(found, -1)))))


def _positions(rows: DataFrame, order: list[str], tag: str) -> DataFrame:
    """``rows`` with pos, their place in their tree by ``order``, and n, the tree's size."""
    sort = ["tree", *order]
    placed = stored(rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
                    .withColumn("at", F.monotonically_increasing_id()), f"{tag}-placed")
    part = F.shiftright("at", 33)
    # one row per tree and range it reaches into: as many as ranges and trees together
    runs = placed.groupBy("tree", part.alias("part")).agg(F.min("at").alias("low"), F.count("*").alias("size"))
    tree = Window.partitionBy("tree")
    runs = runs.select(F.col("tree").alias("of"), F.col("part").alias("in_part"), "low", F.sum("size").over(tree).alias("n"),
                       (F.sum("size").over(tree.orderBy("part")) - F.col("size")).alias("before"))
    return placed.join(runs, (F.col("tree") == F.col("of")) & (part == F.col("in_part"))).withColumn(
        "pos", F.col("at") - F.col("low") + F.col("before")).drop("of", "in_part", "low", "before", "at")


def _blocks(nodes: DataFrame, payload: list[str], tag: str) -> DataFrame:
    members = F.array_sort(F.collect_list(F.struct("pos", "digest", *payload)))
    return stored(nodes.groupBy("tree", F.shiftright("pos", STEP).alias("block"), "n").agg(members.alias("members")), tag)


@dataclass
class Tree:
    """Stored levels of one tree per value of ``tree``; a group's root is the single node of its last level."""
    levels: list[DataFrame]
    payload: list[str]

    def _nodes_above(self, base: int) -> DataFrame:
        return self.levels[base // STEP].select(
            "tree", F.col("block").alias("pos"), "n", F.element_at(F.element_at(_levels(base), -1), 1).alias("digest"))

    def roots(self) -> DataFrame:
        """(tree, digest), one row per tree."""
        return self._nodes_above((len(self.levels) - 1) * STEP).select("tree", "digest")

    def proofs(self, above: DataFrame) -> DataFrame:
        """Every leaf: tree, digest, payload, the columns of ``above`` but its path, and path.

        ``above`` has (tree, path, ...) for every tree: what follows a tree's
        root on the way up. path lists a step per level: whether the sibling
        stands on the left, and its digest, null where a node is alone.
        """
        kept = [c for c in above.columns if c not in ("tree", "path")]
        upper = above.withColumn("pos", F.lit(0).cast("bigint"))
        for base in range((len(self.levels) - 1) * STEP, -1, -STEP):
            def steps(levels: Column, j: Column, base: int = base) -> Column:
                return F.transform(_each_round(_rounds(base)), lambda k: F.struct(
                    (F.call_function("shiftright", j, k) % 2 == 1).alias("left"),
                    F.get(F.get(levels, k), F.call_function("shiftright", j, k).bitwiseXOR(F.lit(1))).alias("digest")))

            below = self.levels[base // STEP].alias("b")
            up = upper.select(F.col("tree").alias("up_tree"), F.col("pos").alias("up_pos"), F.col("path").alias("up_path"), *kept)
            both = below.join(up, (F.col("tree") == F.col("up_tree")) & (F.col("block") == F.col("up_pos")))
            found = both.select("tree", "up_path", *kept, F.explode(bound(_levels(base), lambda levels: F.transform(
                "members", lambda m, j: F.struct(m.alias("m"), steps(levels, j).alias("steps"))))).alias("x"))
            upper = found.select("tree", "x.m.*", *kept, F.concat("x.steps", "up_path").alias("path"))
            if base:
                upper = stored(upper, "paths")
        return upper.drop("pos")


def build_tree(leaves: DataFrame, order: list[str], payload: list[str], tag: str = "merkle") -> Tree:
    """Store every STEP-th level over ``leaves`` (tree, digest, columns of ``order`` and ``payload``).

    Leaves of a tree ascend by ``order`` (nulls first). No leaves: no trees.
    """
    nodes = _positions(leaves, order, tag)
    tree = Tree([_blocks(nodes, payload, f"{tag}-0")], payload)
    most = tree.levels[0].agg(F.max("n")).first()[0] or 1
    height = max(most - 1, 0).bit_length()
    for base in range(STEP, height, STEP):
        tree.levels.append(_blocks(tree._nodes_above(base - STEP), [], f"{tag}-{base}"))
    return tree


@dataclass
class Manifest:
    groups: Tree
    top: Tree

    def root(self) -> str | None:
        """The digest of the whole table; None if it has no rows."""
        found = self.top.roots().first()
        return found and found["digest"]

    def proofs(self) -> DataFrame:
        """One row per leaf: group, leaf, payload columns, subroot, root, path (steps from the leaf to the root)."""
        nothing = F.array().cast("array<struct<left:boolean,digest:string>>")
        top = self.top.proofs(self.top.roots().select("tree", F.col("digest").alias("root"), nothing.alias("path")))
        above = stored(top.select(F.col("group").alias("tree"), F.col("digest").alias("subroot"), "root", "path"), "group-paths")
        found = self.groups.proofs(above)
        return found.withColumnsRenamed({"digest": "leaf", "tree": "group"})


def build_manifest(rows: DataFrame, group: str, order: list[str], leaf: str = "leaf", payload: list[str] | None = None) -> Manifest:
    """The manifest of ``rows``: column ``leaf`` holds digests (lowercase hex), ``group`` the tree of a row.

    Leaves ascend by ``order``, nulls first, and by digest where it ties; rows
    repeated with the same digest are leaves of their own. The groups' roots,
    null group first and then by UTF-8 bytes, are the leaves of the top tree.
    An empty table has a manifest without root and without proofs. Other
    columns are ignored unless ``payload`` names them.
    """
    # a null group stands before the empty name, and an ordinary join key must not be null
    keyed = rows.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
                        F.col(leaf).alias("digest"), *[F.col(c) for c in dict.fromkeys([*order, *(payload or [])])])
    groups = build_tree(keyed, [*order, "digest"], [c for c in keyed.columns if c not in ("tree", "digest")], "merkle")
    subroots = groups.roots().select(F.lit("").alias("tree"), "digest", F.col("tree").alias("group"))
    return Manifest(groups, build_tree(subroots, ["group"], ["group"], "merkle-top"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda at, s: F.sha2(
        F.when(s["digest"].isNull(), at).when(s["left"], F.concat(s["digest"], at)).otherwise(F.concat(at, s["digest"])), 256))


def siblings(path: Column) -> Column:
    """The digests on a path, joined."""
    return F.array_join(F.transform(path, lambda s: s["digest"]), "")


def tampered_proofs(docs: DataFrame, one_in: int = 7) -> DataFrame:
    """Manifest, proofs and their check against rows tampered with, one row per document.

    The leaf of a document is the digest of doc_id, source, lang, n_chars and
    text, each null kept apart from an empty value. Where ``one_in`` divides
    the unsigned CRC-32 of the id's decimal text, the changed row has n_chars
    one larger (a null stays). Null ids are never changed. Other columns are
    ignored. An empty table gives an empty result.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [*fields[:3], fields[3] + 1, fields[4]]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % one_in == 0
    rows = docs.select("doc_id", "lang", leaf_digest(*fields).alias("leaf"),
                       F.when(hit, leaf_digest(*changed)).alias("changed"))
    found = build_manifest(rows, "lang", ["doc_id"], payload=["changed"]).proofs()
    out = found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
                       folded(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
