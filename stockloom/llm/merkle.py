"""Merkle manifest of a dataset: subroots by group, one root, and a proof per row.

A row's leaf is the SHA-256 of its fields.  Inside a group every ``fanout``
consecutive nodes become one, until a single node, the group's subroot, remains;
the subroots, in group order, become the root in the same way.  All digests are
lowercase hex and are hashed as such.

A level is built by a pivot: nodes are grouped by parent, and conditional
aggregates spread them into one column per slot.  The slot columns concatenated
and hashed are the parent; without a node's own slot column they are its
siblings.  Proofs are handed down from the root, so each level joins only its
parents, and the leaves, the widest level, are not joined at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import in_ranges, with_before
from stockloom.session import materialise

FANOUT = 8
#: One step of a proof: what stands left and right of the node in its run.
STEP = "struct<left: string, right: string>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A field of a leaf: its UTF-8 length, a colon and itself; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return digest(*[field(f) for f in fields])


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


@dataclass
class Forest:
    """The levels of one or more trees, the one above the leaves first.

    A level has one row per parent: tree, place (among the tree's parents),
    below (nodes of the tree one level down), c0.. (slots), node (digest);
    the lowest level also has e0.. with the leaves' other columns.
    """

    leaves: DataFrame
    levels: list[DataFrame]
    fanout: int

    @classmethod
    def grow(cls, leaves: DataFrame, carried: list[str], fanout: int, name: str) -> Forest:
        """From rows (tree, place, below, node, *carried); ``place`` counts from
        0 without gaps in each tree and ``below`` is the tree's number of rows."""
        slots = range(fanout)
        nodes, levels = leaves, []
        most = leaves.agg(F.max("below")).first()[0] or 0
        while most > 1:
            extra = [] if levels or not carried else [
                F.max(F.when(F.col("slot") == k, F.struct(*carried))).alias(f"e{k}") for k in slots]
            runs = (nodes.where("below > 1").withColumn("slot", F.col("place") % fanout)
                    .groupBy("tree", F.expr(f"place div {fanout}").alias("place"))
                    .agg(F.max("below").alias("below"), *[F.max(F.when(F.col("slot") == k, F.col("node"))).alias(f"c{k}") for k in slots], *extra))
            level = materialise(runs.withColumn("node", F.sha2(F.concat_ws("", *[f"c{k}" for k in slots]).cast("binary"), 256)), name)
            levels.append(level)
            nodes = level.select("tree", "place", F.expr(f"(below + {fanout - 1}) div {fanout}").alias("below"), "node")
            most = -(-most // fanout)
        return cls(leaves, levels, fanout)

    def tops(self) -> DataFrame:
        """(tree, node): the node that remains of each tree."""
        out = self.leaves.where("below = 1").select("tree", "node")
        for level in self.levels:
            out = out.unionByName(level.where(f"below <= {self.fanout}").select("tree", "node"))
        return out

    def _children(self, parents: DataFrame, payload: bool) -> DataFrame:
        slots = range(self.fanout)
        nothing = F.lit("")
        rows = [F.struct(
            (F.col("place") * self.fanout + k).alias("place"), F.col(f"c{k}").alias("node"),
            F.struct(F.coalesce(F.concat_ws("", *[f"c{i}" for i in slots if i < k]), nothing).alias("left"),
                     F.coalesce(F.concat_ws("", *[f"c{i}" for i in slots if i > k]), nothing).alias("right")).alias("step"),
            *([F.col(f"e{k}").alias("payload")] if payload else [])) for k in slots]
        out = parents.select("tree", "path", "top", F.explode(F.filter(F.array(*rows), lambda r: r["node"].isNotNull())).alias("r"))
        found = out.select("tree", "r.place", "r.node", F.concat(F.array("r.step"), "path").alias("path"), "top", *(["r.payload"] if payload else []))
        return found.select("*", "payload.*").drop("payload") if payload else found

    def paths(self, above: DataFrame, carried: list[str], name: str) -> DataFrame:
        """(tree, place, node, path, top, *carried) of every leaf.

        ``above`` has (tree, path, top): the path from each tree's top onwards
        and a value handed to all leaves of the tree.
        """
        lone = self.leaves.where("below = 1").select("tree", "place", "node", *carried).join(above, "tree")
        found = None
        for i, level in reversed([*enumerate(self.levels)]):
            heads = level.where(f"below <= {self.fanout}").join(above, "tree")
            parents = heads if found is None else heads.unionByName(
                level.where(f"below > {self.fanout}").join(found.select("tree", "place", "path", "top"), ["tree", "place"]))
            found = self._children(parents, payload=i == 0 and bool(carried))
            if i:
                found = materialise(found, name)
        columns = ["tree", "place", "node", "path", "top", *carried]
        return lone.select(columns) if found is None else found.select(columns).unionByName(lone.select(columns))


def _placed(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with tree (a number in the order of ``group``), place and below."""
    order = [group, *order, "copy"]
    staged = in_ranges(rows.withColumn("copy", F.monotonically_increasing_id()), order, name)
    ranked = materialise(with_before(staged, order, {"rank": F.lit(1).cast("long")}).drop("copy"), name)
    trees = ranked.groupBy(group).agg(F.min("rank").alias("tree"), F.count(F.lit(1)).alias("below")).withColumnRenamed(group, "_group")
    return (ranked.join(trees, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
            .withColumn("place", F.col("rank") - F.col("tree")).drop("rank"))


def manifest(leaves: DataFrame, group: str, order: list[str], carried: list[str], fanout: int = FANOUT) -> DataFrame:
    """One row per leaf: ``carried``, group, leaf, subroot, root and path.

    ``leaves`` has the columns ``group``, ``order``, ``carried`` and ``node``
    (the leaf's digest).  Groups, and rows in a group, go by Spark's ascending
    order, nulls first; leaves equal in ``order`` go by their digest, so equal
    rows are interchangeable.  ``path`` holds the steps from the leaf to the
    root; a lone leaf of a lone group is the root and has none.  A group may
    hold any share of the rows: the order is made in ranges that cut through it.
    An empty table gives no rows.  Columns named tree, place, below, rank, copy,
    part, slot, path or top must not be in ``leaves``.
    """
    kept = list(dict.fromkeys([group, *carried]))
    rows = _placed(leaves.select(*dict.fromkeys([group, *order, *carried, "node"])), group, [*order, "node"], "merkle-leaves")
    rows = materialise(rows.select("tree", "place", "below", "node", *kept), "merkle-placed")
    groups = Forest.grow(rows, kept, fanout, "merkle-level")
    subroots = materialise(groups.tops().select("tree", "node"), "merkle-subroots")
    named = subroots.select(F.lit(0).alias("all"), F.col("tree").alias("of"), "node")
    crown = Forest.grow(materialise(_placed(named, "all", ["of"], "merkle-crown").select("tree", "place", "below", "node", "of"), "merkle-crown"),
                        ["of"], fanout, "merkle-crown")
    start = crown.tops().select("tree", F.expr(f"cast(array() as array<{STEP}>)").alias("path"), F.col("node").alias("top"))
    above = materialise(crown.paths(start, ["of"], "merkle-crown-path").select(
        F.col("of").alias("tree"), "path", F.struct(F.col("node").alias("subroot"), F.col("top").alias("root")).alias("top")), "merkle-above")
    return groups.paths(above, kept, "merkle-path").select(
        *kept, F.col("node").alias("leaf"), "top.subroot", "top.root", "path")


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def verified_documents(docs: DataFrame, every: int = 3, fanout: int = FANOUT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified per row.

    The leaf hashes ``FIELDS``, groups are languages, rows go by doc_id.  Where
    ``every`` divides the CRC-32 of the decimal doc_id, the text's A-Z are
    lower-cased before its leaf is hashed again and folded with the original
    siblings; a null doc_id is never tampered with, a null text stays null.
    ``verified`` tells whether the folded root is the root.  Null ids and null
    languages come first; repeated rows are leaves of their own.  Other columns
    are ignored.
    """
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    columns = [F.col(c) for c in FIELDS]
    leaves = docs.select("doc_id", "lang", leaf_of(*columns).alias("node"),
                         F.when(hit, leaf_of(*columns[:-1], lower)).alias("tampered"))
    proven = manifest(leaves, "lang", ["doc_id"], ["doc_id", "tampered"], fanout)
    folded = proven.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
