"""Merkle manifest of a dataset: sibling-shift self-joins, level by level, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.operators.durable import durable

#: Children of a node, and what makes a leaf.
FAN_OUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def hexed(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def leaf_of(fields: list[Column]) -> Column:
    return digest(F.concat(*[encoded(f) for f in fields]))


def placed(rows: DataFrame, group: str, order: list[str], label: str, trees: DataFrame | None = None) -> DataFrame:
    """The rows with ``idx``, gapless from 0 within their group, and the group's size ``n``.

    Rows are dealt out by ranges of group and order, so a group of any size lies over many tasks;
    a row's index is its place in its range plus the rows of its group in earlier ranges. The last
    order column must tell all rows apart for hot keys to be split too. ``trees`` (tree_source,
    tree) adds the number of the group; it is joined to the ranges, not to the rows.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = durable(ranged.withColumn("place", F.monotonically_increasing_id()).withColumn(
        "part", F.shiftrightunsigned("place", 33)), label)
    spans = ranged.groupBy(group, "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("held"))
    whole = Window.partitionBy(group)  # one row per group and range, never the rows
    earlier = F.sum("held").over(whole.orderBy("part")) - F.col("held")
    spans = spans.select(
        F.col(group).alias("span_group"), F.col("part").alias("span_part"),
        (earlier - F.col("first")).alias("offset"), F.sum("held").over(whole).alias("n"))
    added = ["idx", "n"]
    if trees is not None:
        spans = spans.join(trees.select("tree_source", "tree"), F.col("span_group").eqNullSafe(F.col("tree_source")))
        added.append("tree")
    same = (F.col("part") == F.col("span_part")) & F.col(group).eqNullSafe(F.col("span_group"))
    return ranged.join(spans, same).withColumn("idx", F.col("place") + F.col("offset")).select(*rows.columns, *added)


def with_siblings(nodes: DataFrame, slot_zero: bool = False, fan_out: int = FAN_OUT) -> DataFrame:
    """Nodes with ``left`` and ``right``: the digests of their run before and after them, one after another.

    Every node is sent to its siblings' indices (shifted by 1, 2, ... slots within the run) and
    equijoined with the nodes there. A run has at most ``fan_out`` nodes, so no key is hot. With
    ``slot_zero`` only first nodes of runs are made, and only copies meant for them are sent.
    """
    slot = F.col("idx") % fan_out
    # from the highest slot a node shifts 1 .. fan_out - 1 round its run, as any other does
    shifts = F.array((F.lit(fan_out) - slot)) if slot_zero else F.sequence(F.lit(1), F.lit(fan_out - 1)).cast("array<bigint>")
    copies = nodes.select("tree", "idx", "n", "hash", F.explode(shifts).alias("shift")).where(
        F.col("shift") < fan_out).select(
        F.col("tree").alias("to_tree"), (F.col("idx") - slot + (slot + F.col("shift")) % fan_out).alias("to_idx"),
        "n", F.struct("idx", "hash").alias("sibling")).where("to_idx < n").drop("n")
    own = nodes.where(slot == 0) if slot_zero else nodes
    payload = [c for c in nodes.columns if c not in ("tree", "idx")]
    met = own.join(copies, (F.col("tree") == F.col("to_tree")) & (F.col("idx") == F.col("to_idx")), "left").groupBy(
        "tree", "idx").agg(
        *[F.first(c).alias(c) for c in payload], F.array_sort(F.collect_list("sibling")).alias("siblings"))

    def joined(keep) -> Column:
        return F.unhex(F.array_join(F.transform(F.filter("siblings", keep), lambda s: F.hex(s["hash"])), ""))

    return met.select(
        *nodes.columns, joined(lambda s: s["idx"] < F.col("idx")).alias("left"),
        joined(lambda s: s["idx"] > F.col("idx")).alias("right"))


def climb(leaves: DataFrame, label: str, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Nodes of all levels, (tree, idx, n, hash): the leaves as given, then their parents, up to one node a tree.

    A tree is in the list up to the level at which one node remains.
    """
    levels, most = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        below = levels[-1].where("n > 1").select("tree", "idx", "n", "hash")
        parents = with_siblings(below, slot_zero=True, fan_out=fan_out).select(
            "tree", F.expr(f"idx div {fan_out}").alias("idx"),
            F.ceil(F.col("n") / fan_out).cast("long").alias("n"),
            digest(F.concat(hexed(F.col("hash")), hexed(F.col("right")))).alias("hash"))
        levels.append(durable(parents, f"{label}-level"))
        most = -(-most // fan_out)
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(tree, hash) of the one node that remains of each tree."""
    found = None
    for level in levels:
        one = level.where("n = 1").select("tree", "hash")
        found = one if found is None else found.unionByName(one)
    return found


def descend(levels: list[DataFrame], above: DataFrame, label: str, fan_out: int = FAN_OUT) -> DataFrame:
    """The leaves with ``top`` (their tree's last node) and ``path``: left and right siblings from the leaf to the root.

    ``above`` has (tree, path): what follows above the last node of a tree. A path is made once per
    node and handed down to its children; at the leaves it meets (tree, parent), at most ``fan_out``
    rows a key.
    """
    above = above.select(F.col("tree").alias("top_tree"), F.col("path").alias("above_path"))
    paths = None
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        last = level.where("n = 1").join(above, F.col("tree") == F.col("top_tree")).select(
            *level.columns, F.col("hash").alias("top"), F.col("above_path").alias("path"))
        if paths is not None:
            parents = paths.select(
                F.col("tree").alias("up_tree"), F.col("idx").alias("up_idx"), F.col("top"), F.col("path").alias("up_path"))
            inner = with_siblings(level.where("n > 1"), fan_out=fan_out).withColumn("parent", F.expr(f"idx div {fan_out}"))
            step = F.array(F.struct("left", "right"))
            last = inner.join(parents, (F.col("tree") == F.col("up_tree")) & (F.col("parent") == F.col("up_idx"))).select(
                *level.columns, "top", F.concat(step, "up_path").alias("path")).unionByName(last)
        paths = last if k == 0 else durable(last, f"{label}-paths")
    return paths


@dataclass
class Manifest:
    """Trees of one dataset: nodes by level, the sources' own trees and the tree over them."""

    sources: DataFrame  # tree_source, tree, n_sources
    levels: list[DataFrame]
    source_levels: list[DataFrame]
    root: str | None

    def proofs(self) -> DataFrame:
        """The leaves with their own columns, ``subroot`` and ``path`` (an array of left and right siblings)."""
        nothing = self.levels[0].sparkSession.range(1).selectExpr(
            "id as tree", "cast(array() as array<struct<left:binary,right:binary>>) as path")
        over = descend(self.source_levels, nothing, "merkle-sources")
        over = over.select(F.col("idx").alias("tree"), "path")
        return descend(self.levels, over, "merkle").withColumnRenamed("top", "subroot")


def build_manifest(leaves: DataFrame) -> Manifest:
    """The trees over leaves (source, doc_id, hash and columns to carry).

    A source's leaves are ordered by doc_id (null first), then digest, so the manifest does not
    depend on how rows are spread. Sources are ordered bytewise, null first.
    """
    rows = durable(leaves.withColumn("turn", F.monotonically_increasing_id()), "merkle-leaves")
    named = rows.select("source").distinct().withColumn("forest", F.lit(0))
    sources = durable(placed(named, "forest", ["source"], "merkle-sources").select(
        F.col("source").alias("tree_source"), F.col("idx").alias("tree"), F.col("n").alias("n_sources")), "merkle-trees")
    nodes = durable(placed(
        rows, "source", ["doc_id", "hash", "turn"], "merkle-placed", sources).drop("turn", "source"), "merkle-nodes")
    levels = climb(nodes, "merkle")
    ends = tops(levels).join(sources.withColumnRenamed("tree", "source_tree"), F.col("tree") == F.col("source_tree"))
    source_levels = climb(durable(ends.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("n_sources").alias("n"), "hash"),
        "merkle-subroots"), "merkle-sources")
    root = tops(source_levels).select(hexed(F.col("hash"))).head()
    return Manifest(sources, levels, source_levels, root and root[0])


def document_leaves(docs: DataFrame) -> DataFrame:
    """source, doc_id, the leaf's digest, and the digest after tampering where a document is tampered with."""
    fields = [F.col(c) for c in FIELDS]
    lowered = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return docs.select(
        F.col("source").alias("source"), F.col("doc_id").alias("doc_id"), leaf_of(fields).alias("hash"),
        F.when(chosen, leaf_of([*fields[:-1], lowered])).alias("tampered"))


def audit(docs: DataFrame) -> DataFrame:
    """One row per row of documents: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The manifest is built from the documents as they are; then every document is checked against
    its proof, a fifth of them with the text's A-Z lower-cased first. Nulls in any field have an
    encoding of their own; a null id is never tampered with and comes first in its source; repeated
    ids and rows are leaves of their own, those with one id in the order of their digests. One
    document alone is the root, with an empty proof. An empty table gives no rows; columns beside
    the five fields are ignored.
    """
    manifest = build_manifest(document_leaves(docs))
    pieces = F.flatten(F.transform("path", lambda p: F.array(hexed(p["left"]), hexed(p["right"]))))
    folded = F.aggregate(
        "path", hexed(F.coalesce("tampered", "hash")),
        lambda own, p: F.sha2(F.concat(hexed(p["left"]), own, hexed(p["right"])), 256))
    return manifest.proofs().select(
        "doc_id", hexed(F.col("hash")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
        F.lit(manifest.root).cast("string").alias("root"), F.sha2(F.array_join(pieces, ""), 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
