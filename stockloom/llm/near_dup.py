"""Near-duplicate groups from fast similarity sketches.

A document is the set of its distinct word shingles.  Its sketch is filled in
rounds: in each of the first t rounds every shingle is thrown into a random bin
with the round number as the high part of its value; a bin keeps its least
value.  Bins that stay empty are filled by one guaranteed round each.  All
coordinates are therefore filled, and two sketches agree in a share of
coordinates close to the sets' similarity.  Sketches are cut into bands; sets
that share a band are compared exactly.

Equal sets are one class from the start, so copies never multiply.  Within a
band's bucket every class is first compared with the bucket's smallest class
only.  Where a bucket still spans several components after that, the classes
outside the largest component are compared, block by block, with every class of
the other components, so no link between two components that share a band is
lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import ascii_words, mix, with_python
from stockloom.session import materialise

BANDS, ROWS = 64, 8
#: Bytes of shingle hashes in a block of sets that one task compares.
BLOCK_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BALLS = 4096


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a text with fewer
    words is one shingle, a text without words none."""
    words = ascii_words(text)
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(w) - size + 1)
    h = np.full(n, np.uint64(min(size, len(w))))
    for i in range(min(size, len(w))):
        h = mix(h * _STEP + w[i:i + n])
    return np.unique(h)


def fast_sketch(x: np.ndarray, bins: int) -> np.ndarray:
    """The sketch of a non-empty set of hashes; values carry their round."""
    out = np.full(bins, np.uint64(0xFFFFFFFFFFFFFFFF))
    low = np.uint64(0xFFFFFFFF)
    step = max(1, _BALLS // len(x))
    for first in range(0, bins, step):
        rounds = np.arange(first, min(bins, first + step), dtype=np.uint64)
        h = mix(x[None, :] + mix((rounds + np.uint64(1)) * _STEP)[:, None])
        where = ((h & low) * np.uint64(bins)) >> np.uint64(32)
        np.minimum.at(out, where.ravel().astype(np.int64), ((rounds[:, None] << np.uint64(32)) | (h >> np.uint64(32))).ravel())
        empty = np.flatnonzero(out == np.uint64(0xFFFFFFFFFFFFFFFF))
        if not len(empty):
            return out
    for b in empty:
        i = np.uint64(bins + int(b))
        h = mix(x + mix((np.array([i]) + np.uint64(1)) * _STEP)) >> np.uint64(32)
        out[b] = (i << np.uint64(32)) | h.min()
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.arange(bands, dtype=np.uint64) * _STEP
    for j in range(rows):
        keys = mix(keys * _STEP + sketch.reshape(bands, rows)[:, j])
    return keys.view(np.int64)


def _sketched(df: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int) -> DataFrame:
    def sketched(b: pa.RecordBatch) -> dict[str, list]:
        sizes, digests, keys = [], [], []
        for text in b.column("text").to_pylist():
            x = shingle_hashes(text, shingle)
            sizes.append(len(x))
            digests.append(xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None)
            keys.append(band_keys(fast_sketch(x, bands * rows), bands, rows) if len(x) else None)
        return {"n_shingles": sizes, "digest": digests, "bands": keys}

    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"))
    return with_python(narrow, sketched, "n_shingles long, digest binary, bands array<long>", drop=("text",))


def _grams(df: DataFrame, shingle: int) -> DataFrame:
    """(text) to (digest, grams): the whole set as bytes of 64-bit hashes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingle_hashes(t, shingle) for t in b["text"]]
            yield pd.DataFrame({"digest": [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets],
                                "grams": [x.tobytes() for x in sets]})

    return df.select("text").mapInPandas(run, "digest binary, grams binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["ga"], batch["gb"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[keep, ["a", "b"]]

    size_a, size_b = F.length("ga"), F.length("gb")
    full = (pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b")
            .where(100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)))
    return full.select("a", "b", "ga", "gb").mapInPandas(run, "a long, b long")


def _compare_blocks(percent: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Compares every left set with every right one; gives a link for each two
    components that meet for the first time."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        if len(left) and len(right):
            sets = [np.frombuffer(g, np.uint64) for g in right["y_grams"]]
            sizes = np.array([len(x) for x in sets])
            owner = np.repeat(np.arange(len(sets)), sizes)
            hashes = np.concatenate(sets)
            order = np.argsort(hashes, kind="stable")
            hashes, owner = hashes[order], owner[order]
            nodes, comps = right["y_node"].to_numpy(), right["y_comp"].to_numpy()
            parent: dict[int, int] = {}

            def root(c: int) -> int:
                while parent.get(c, c) != c:
                    c = parent[c] = parent.get(parent[c], parent[c])
                return c

            for x, comp, grams in zip(left["x_node"], left["x_comp"], left["x_grams"]):
                mine = np.frombuffer(grams, np.uint64)
                lo, hi = np.searchsorted(hashes, mine, "left"), np.searchsorted(hashes, mine, "right")
                n = hi - lo
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(sets))
                near = np.flatnonzero((100 * both >= percent * (len(mine) + sizes - both)) & (comps != comp))
                for i in near[np.unique(comps[near], return_index=True)[1]]:
                    a, b = root(int(comp)), root(int(comps[i]))
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        out.append((int(x), int(nodes[i])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _between_components(rest: DataFrame, clusters: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a bucket (band, node, comp).

    The nodes of a cluster, the nodes joined by buckets, are cut into blocks of
    bounded size.  Two blocks are compared if one holds a node outside its
    cluster's largest component that shares a bucket with a node of the other.
    Sets are compared inside the task, all of one block with all of the other;
    no pair is a row, and only links that join two components come out.
    """
    nodes = rest.select("node", "comp").distinct().join(clusters, "node").join(sets, "node")
    sized = nodes.groupBy("cluster", "comp").agg(F.count("*").alias("n"), F.sum(F.length("grams")).alias("bytes"))
    shape = sized.groupBy("cluster").agg(
        F.max(F.struct("n", "comp"))["comp"].alias("main"), F.ceil(F.sum("bytes") / BLOCK_BYTES).alias("blocks"))
    blocked = materialise(nodes.join(shape, "cluster").select(
        "node", "comp", "grams", "cluster", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"),
        (F.col("comp") != F.col("main")).alias("outside")), "near-dup-blocks")
    near = rest.select("band", "node").join(blocked.select("node", "cluster", "block", "outside"), "node")
    lefts = near.where("outside").select("band", "cluster", F.col("block").alias("x")).distinct()
    rights = near.select("band", F.col("block").alias("y")).distinct()
    tasks = lefts.join(rights, "band").select("cluster", "x", "y").distinct()
    left, right = (
        blocked.where(where).alias("s").join(tasks.alias("t"), F.expr(f"s.cluster = t.cluster and s.block = t.{end}"))
        .select(*[F.col(f"t.{c}").alias(f"{end}_{c}") for c in ("cluster", "x", "y")], *[F.col(f"s.{c}").alias(f"{end}_{c}") for c in ("node", "comp", "grams")])
        for end, where in (("x", "outside"), ("y", "true")))
    return (left.groupBy("x_cluster", "x_x", "x_y").cogroup(right.groupBy("y_cluster", "y_x", "y_y"))
            .applyInPandas(_compare_blocks(percent), "a long, b long"))


def components(links: DataFrame, name: str = "component") -> DataFrame:
    """(node, comp) for the nodes of links (a, b): comp is the least node reachable.

    Every node takes the least label next to it, then the label of that label,
    until nothing changes; each pass is a stage in the shared folder.
    """
    both = materialise(links.union(links.select("b", "a")).toDF("node", "other").distinct(), f"{name}-links")
    labels = materialise(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("comp")), name)
    while True:
        near = (both.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("comp").alias("near")))
        step = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("comp").alias("far"))
        new = materialise(step.join(jump, "mid").select("node", "old", F.col("far").alias("comp")), name)
        if new.where("old <> comp").isEmpty():
            return new.drop("old")
        labels = new.drop("old")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: id, text_key, n_shingles, component_id, kept.

    Two rows are linked when 100 * common shingles >= percent * all shingles of
    the two; ``component_id`` is the smallest id reachable, ``kept`` says that
    the row carries it.  A null or empty text, or one without words, has no
    shingles and is linked with nothing.  Rows of equal sets, repeated rows
    included, are one class.  A null id never names a component that has other
    ids; a group of null ids only has a null component and is kept.  Other
    columns of the input are ignored.
    """
    rows_of = materialise(_sketched(df, id_col, text_col, shingle, bands, rows), "near-dup-rows")
    classes = materialise(
        rows_of.where("digest is not null").groupBy("digest")
        .agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "near-dup-classes")
    members = classes.select("node", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    crowded = materialise(members.join(shared.select("band", "low"), "band"), "near-dup-buckets")

    wanted = crowded.select("node").distinct().join(classes.select("node", "digest", "rep"), "node")
    texts = (df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).alias("d")
             .join(wanted.select("rep").distinct().alias("w"), F.expr("d.id <=> w.rep"), "left_semi"))
    sets = materialise(
        _grams(texts, shingle).join(wanted.select("digest", "node"), "digest")
        .groupBy("node").agg(F.first("grams").alias("grams")), "near-dup-sets")

    first = crowded.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    links = materialise(_verified(first, sets, percent), "near-dup-links")
    found = components(links)
    placed = crowded.join(found, "node", "left").select("band", "node", F.coalesce("comp", "node").alias("comp"))
    split = placed.groupBy("band").agg(F.min("comp").alias("one"), F.max("comp").alias("other")).where("one < other")
    rest = materialise(placed.join(split.select("band"), "band"), "near-dup-rest")
    if not rest.isEmpty():
        clusters = components(first, "near-dup-cluster").withColumnRenamed("comp", "cluster")
        more = materialise(_between_components(rest, clusters, sets, percent), "near-dup-more")
        found = components(links.union(more))

    named = classes.select("digest", "node", "rep").join(found, "node", "left") \
        .withColumn("comp", F.coalesce("comp", "node"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    by_digest = named.join(least, "comp").select("digest", "component_id")
    return (rows_of.select("id", "text_key", "n_shingles", "digest").join(by_digest, "digest", "left")
            .select(F.col("id").alias(id_col), "text_key", "n_shingles",
                    F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.expr(f"{id_col} <=> component_id")))
