"""The pipeline against a plain run over the same stages' decisions."""

import collections
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_mix_and_shards import plain_mix
from test_near_dup import brute
from test_pages_and_leaks import grams
from tokenizers import Tokenizer

import corpus_pipeline
from stockloom.llm import cotraining

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    kept = {r.doc_id for r in cotraining.quality_scores(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).where("kept").collect()}
    rows = [r for r in rows if r["doc_id"] in kept]
    assert 0 < len(rows) < docs.count()
    groups = {d: c for d, _, c in brute([(r["doc_id"], r["text"]) for r in rows], 5, 80)}
    rows = [r for r in rows if groups[r["doc_id"]] == r["doc_id"]]
    items = [grams(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(i and 100 * len(i & grams(r["text"])) >= 80 * len(i) for i in items)]
    times = {d: taken // size for d, size, _, _, taken in plain_mix([(r["doc_id"], r["text"], r["source"]) for r in rows]) if size}
    rows = sorted((r for r in rows for _ in range(times.get(r["doc_id"], 0))), key=lambda r: r["doc_id"])
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    want, start = [], 0
    for r in rows:
        ids = t.encode(r["text"], add_special_tokens=False).ids + [2]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_stage_columns_and_odd_rows(spark, docs):
    rows = [(1, "some plain words in a row here"), (1, "some plain words in a row here"), (2, "some plain words in a row here"), (3, None), (4, ""),
            (None, "text without an id but with words"), (5, "long " * 50_000), (1, "another text under the same id")]
    df = docs(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, FOLDER)
        assert out.columns == df.columns, name
        assert stage(spark, df.limit(0), FOLDER).count() == 0, name
    kept = collections.Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, df, FOLDER).collect())
    assert kept == collections.Counter({(1, rows[0][1]): 1, (3, None): 1, (4, ""): 1, (None, rows[5][1]): 1, (5, rows[6][1]): 1, (1, rows[7][1]): 1})
    assert corpus_pipeline.token_output(spark, df, FOLDER).agg(F.count("*")).first()[0] == len(rows)


def test_short_items_are_found_inside_documents(spark, docs, tmp_path):
    items = [(1, "secret"), (None, "blue whale song"), (3, "北京烤鸭"), (4, "one two three four five six")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, "a long text that holds one secret word here"), (2, "they play a blue whale song every day"), (3, "昨天我们在城里吃了北京烤鸭很好"),
            (4, "so one two three four five six it goes"), (5, "a blue song of the whale and nothing else"), (6, "北京的烤鸭店今天没有开门"),
            (7, None), (8, "blue whale"), (9, "Secret!")]
    got = corpus_pipeline.decontamination(spark, docs(rows), str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == [5, 6, 7, 8]
