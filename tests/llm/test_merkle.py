"""Merkle manifest against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from stockloom.llm import merkle
from stockloom.llm.queries import QUERIES


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain(rows, fanout=8):
    """{(doc_id, leaf)}: sorted results of a plain computation."""
    def rise(nodes, paths):
        members = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            above = []
            for at in range(0, len(nodes), fanout):
                run = range(at, min(at + fanout, len(nodes)))
                for k in run:
                    step = ("".join(nodes[at:k]), "".join(nodes[k + 1:run.stop]))
                    for i in members[k]:
                        paths[i].append(step)
                above.append((sha("".join(nodes[at:run.stop])), [i for k in run for i in members[k]]))
            nodes, members = [n for n, _ in above], [m for _, m in above]
        return nodes[0]

    lowered = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    out, tops, trees = [], [], []
    for lang in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        made = []
        for r in groups[lang]:
            head = "".join(field(r[c]) for c in merkle.FIELDS[:-1])
            leaf = sha(head + field(r["text"]))
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            low = None if r["text"] is None else r["text"].translate(lowered)
            made.append((r["doc_id"], leaf, sha(head + field(low)) if hit else leaf))
        made.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
        paths = [[] for _ in made]
        tops.append(rise([m[1] for m in made], paths))
        trees.append((made, paths))
    crown = [[] for _ in tops]
    root = rise(tops, crown) if tops else None
    for (made, paths), top, rest in zip(trees, tops, crown):
        for (i, leaf, seen), path in zip(made, paths):
            node = seen
            for left, right in path + rest:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in path + rest))
            out.append((i, leaf, top, root, proof, node, node == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def result(df):
    return sorted([tuple(r) for r in merkle.verified_documents(df).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()], key=repr)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_odd_rows(spark):
    langs = [None, "", "en", "de", "é", "日", "a", "b", "c", "zz", "en-GB"]
    rows = [(i, "s" if i % 3 else None, langs[i * i % len(langs)], i % 5 or None, ["Ab C", None, "", "É日A" * 50, "plain"][i % 5]) for i in range(150)]
    rows += [(i, "s", "hot", 1, "Same Text") for i in range(200, 275)]
    rows += [(7, "s", "en", 1, "Again")] * 20 + [(7, "s", "en", 1, "Other")] + [(None, "s", "en", 1, "No Id")] * 3 + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = result(df)
    assert got == plain(rows_of(df))
    assert result(df.repartition(7)) == got
    shown = {r[6] for r in got}
    assert shown == {True, False}


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_sizes_of_one_group(spark, n):
    df = spark.createDataFrame([(i, "s", "en", 1, f"T {i}") for i in range(n)], SCHEMA)
    assert result(df) == plain(rows_of(df))


def test_empty_table(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []


def test_clashing_columns_and_long_texts(spark):
    rows = [(1, "s", "en", 3, "X" * 400_000), (2, "s", "en", 3, "x"), (3, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    more = df
    for c in ("tree", "place", "below", "node", "rank", "copy", "part", "path", "top", "root", "leaf", "tampered", "_group"):
        more = more.withColumn(c, F.lit("x"))
    assert result(more) == plain(rows_of(df))


def test_fanout_is_a_parameter(spark):
    df = spark.createDataFrame([(i, "s", "en", 1, f"T {i}") for i in range(30)], SCHEMA)
    got = merkle.verified_documents(df, fanout=3).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows_of(df), fanout=3)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = QUERIES["op11_merkle_manifest"](spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows_of(df))
