"""Mixing and sharding against plain versions."""

import hashlib
import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from stockloom.llm.hilbert import hilbert_index, hilbert_shards, with_rank, write_shards
from stockloom.llm.mixing import mix, mix_report
from stockloom.llm.queries import QUERIES


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, free = {}, share * sum(sizes.values()), set(order)
    while free:  # stop the sources that are above, share the rest again
        rate = left / sum(weight[s] for s in free)
        above = {s for s in free if rate * weight[s] > most * sizes[s]}
        if not above:
            return target | {s: rate * weight[s] for s in free}
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= above
    return target


def plain_mix(rows):
    size = [len((t or "").split()) for _, t, _ in rows]
    u = [int(hashlib.md5(f"{'' if i is None else i}|{t or ''}".encode()).hexdigest()[:12], 16) for i, t, _ in rows]
    sizes = {}
    for n, (_, _, s) in zip(size, rows):
        sizes[s] = sizes.get(s, 0) + n
    target, out = plain_targets(sizes), []
    for s in sizes:
        passes = int(target[s] // sizes[s]) if sizes[s] else 0
        rest, run, cut = target[s] - passes * sizes[s], 0, -1
        for value, group in itertools.groupby(sorted((x, n) for x, n, r in zip(u, size, rows) if r[2] == s), key=lambda g: g[0]):
            own = sum(n for _, n in group)
            if run <= rest and (run + own <= rest or run + own - rest < rest - run):
                cut = value
            run += own
        out += [(r[0], n, sizes[s], round(target[s], 6), n * (passes + (x <= cut))) for x, n, r in zip(u, size, rows) if r[2] == s]
    return sorted(out, key=repr)


def corpus(n=400):
    rng = random.Random(5)
    source = lambda: "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "é", "Z", None, "zero"])
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(1.2) * 5)), source()) for i in range(n)]
    return [(i, None if s == "zero" else t, s) for i, t, s in rows] + [(None, "no id", "a"), (3, "again", "b"), (3, "again", "b"), (n, "", "hot")]


def frame(docs, rows, extra=False):
    return docs([(i, t, "en", s) for i, t, s in rows], extra)


def test_mix_against_plain(spark, docs):
    rows = corpus()
    got = mix_report(frame(docs, rows, extra=True)).collect()
    assert sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in got), key=repr) == plain_mix(rows)
    assert all(r.taken <= 2 * r["size"] for r in got)
    assert sum({s: 0 for s in ()}.values(), sum(r.taken for r in got)) > 0


def test_mix_rows_and_reruns(spark, docs):
    df = frame(docs, corpus(150), extra=True)
    out = mix(df)
    assert out.columns == df.columns
    counts = {tuple(r): r["count"] for r in out.groupBy("doc_id", "text", "source").count().collect()}
    report = mix_report(df).where("taken > 0")
    assert sum(counts.values()) == report.agg(F.sum("copies")).first()[0]
    assert sorted(map(repr, report.collect())) == sorted(map(repr, mix_report(df.repartition(7)).where("taken > 0").collect()))


def test_mix_of_nothing(spark, docs):
    assert mix_report(docs([])).count() == 0 and mix(docs([])).count() == 0
    assert [r.taken for r in mix_report(docs([(1, None), (2, "")])).collect()] == [0, 0]


def test_curve_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        index = hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        walk = cells[np.argsort(index)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def sharded(df, shards=40):
    rows = df.select("doc_id", F.length("text").alias("size"), "lang", "source")
    rows = with_rank(with_rank(rows, "lang", "l"), "source", "s")
    return hilbert_shards(rows, {"_l": F.col("l"), "_s": F.col("s"), "_n": F.col("size")}, ["size", "doc_id"], shards)


def test_shards_even_and_gapless(spark, docs):
    for n in (0, 1, 39, 40, 41, 333):
        rng = random.Random(n)
        rows = [(i, None if i % 9 == 0 else "x" * rng.randrange(50), rng.choice([None, "en", "de"]), "hot" if i % 3 else f"s{i}") for i in range(n)]
        got = sharded(docs(rows)).collect()
        assert len(got) == n
        slots = {}
        for r in got:
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        counts = [len(slots.get(k, ())) for k in range(40)]
        assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(40))


def test_files_prune_in_each_dimension(spark, docs, tmp_path):
    rng = random.Random(8)
    rows = [(i, "x" * rng.randrange(1, 4000), rng.choice(["en", "de", "fr", "es"]), f"s{rng.randrange(16):02d}") for i in range(4000)]
    out = sharded(docs(rows), 64)
    write_shards(out, str(tmp_path / "out"), ["curve"])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4000
    for column in ("l", "s", "size"):
        spans = back.groupBy("shard").agg(F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        values = [r[0] for r in back.select(column).limit(50).collect()]
        touched = np.mean([sum(r.lo <= v <= r.hi for r in spans) / len(spans) for v in values])
        assert touched < 0.75, column


def test_sources_of_one_beginning_are_told_apart(spark, tmp_path):
    """Through the query: shards can be pruned by source although the names begin alike."""
    names = [f"https://common.crawl/{i:02d}" for i in range(8)] + [None]
    rows = [(i, "x" * (i * 37 % 2000), "en", names[i % 9], 0) for i in range(1800)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    shards = {}
    for r in QUERIES["op10_hilbert_shards"](spark, str(tmp_path)).collect():
        shards.setdefault(r.shard, set()).add(names[r.doc_id % 9])
    assert len(shards) == 40 and np.mean([len(s) for s in shards.values()]) < 4


def plain_shards(rows, shards=40, bits=8):
    """Sorted (doc_id, size, text_crc32, shard, slot): ranks, quantiles, curve and
    cuts of (doc_id, text, lang, source), in one process."""
    def ranks(values):
        known = {v: i for i, v in enumerate(sorted({v for v in values if v is not None}, key=str.encode))}
        return [known.get(v, -1) for v in values]

    raw = [(t or "").encode() for _, t, *_ in rows]
    sizes = [len(r) + 16 for r in raw]
    columns = [ranks([r[2] for r in rows]), ranks([r[3] for r in rows]), sizes]
    n, cells = len(rows), []
    if not n:
        return []
    for values in columns:
        ordered = sorted(values)
        cuts = sorted({ordered[max(0, -(-i * n // (1 << bits)) - 1)] for i in range(1, 1 << bits)})
        cells.append([(sum(c <= v for c in cuts) << bits) // (len(cuts) + 1) for v in values])
    curve = hilbert_index(np.array(cells).T, bits).tolist() if n else []
    keys = sorted((k, s, zlib.crc32(r), (i is not None, i or 0)) for k, s, r, (i, *_) in zip(curve, sizes, raw, rows))
    out = []
    for rank, (_, size, crc, (known, i)) in enumerate(keys):
        shard = rank * shards // n
        out.append((i if known else None, size, crc, shard, rank - -(-shard * n // shards)))
    return sorted(out, key=repr)


def test_shards_against_plain(spark, tmp_path):
    """Through the query, with null ids, repeated rows, ties and clashing names."""
    rng = random.Random(5)
    rows = [(rng.choice([None, i % 70, i]), rng.choice([None, "", "é" * (i % 9), "word " * rng.randrange(400)]),
             rng.choice([None, "en", "de", "日本"]), "hot" if i % 3 else f"s{i % 11}") for i in range(500)]
    rows += [(5, "the very same row", "en", "hot")] * 200 + [(None, "x" * 200_000, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for k, n in enumerate((0, 1, 40, len(rows))):
        path = tmp_path / str(k)
        df = frame.limit(n).select("*", *[F.lit("x").alias(c) for c in ("curve", "shard", "slot", "rank", "rows", "part", "copy", "row", "dim0", "tie0")])
        df.write.parquet(str(path / "documents.parquet"))
        got = QUERIES["op10_hilbert_shards"](spark, str(path)).collect()
        kept = [tuple(r)[:4] for r in spark.read.parquet(str(path / "documents.parquet")).collect()]
        assert sorted(((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got), key=repr) == plain_shards(kept)


def test_names_of_the_input_do_not_matter(spark):
    df = spark.range(100).select("id", *[F.lit(c).alias(c) for c in ("curve", "shard", "rank", "rows", "part", "copy", "row", "dim0", "tie0")])
    out = hilbert_shards(df, {"_i": F.col("id")}, ["id"], 10)
    assert out.columns == ["id", "rank", "rows", "part", "copy", "row", "dim0", "tie0", "curve", "shard", "slot"]
    assert out.where("rank = 'rank' and row = 'row'").count() == 100 and out.groupBy("shard").count().where("count = 10").count() == 10


def test_equal_rows_span_ranges(spark):
    df = spark.range(4000).select(F.lit(1).alias("size"), F.lit(None).cast("long").alias("doc_id"))
    assert hilbert_shards(df, {"_n": F.col("size")}, ["size", "doc_id"], 40).groupBy("shard").count().where("count = 100").count() == 40
    from stockloom.llm.common import in_ranges
    parts = in_ranges(df.withColumn("copy", F.monotonically_increasing_id()), ["size", "doc_id", "copy"], "test").groupBy("part").count()
    assert parts.count() == 8 and parts.agg(F.max("count")).first()[0] < 1000


def test_crc_is_zlib(spark):
    assert spark.range(1).select(F.crc32(F.lit("é").cast("binary"))).first()[0] == zlib.crc32("é".encode())
