"""From raw documents to token records: quality, duplicates, benchmark, mix, output.

Each stage takes (spark, docs, folder of the tables), works on all rows of the
stage before, and is written as Parquet and read again.  All but the last return
the columns of documents; the last returns one row per written record.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm import cotraining, decontaminate, mixing, near_dup, records
from stockloom.llm.queries import END_ID, tokenizer_files
from stockloom.session import materialise, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    ship_package(spark)
    return cotraining.drop_bad(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, repeated rows too.

    Five-word shingles, similarity 0.8 or more.  Rows are matched by id and
    text, so rows that share an id but not a text are told apart; of rows that
    differ in other columns only, the least in those stays.
    """
    ship_package(spark)
    kept = near_dup.near_duplicates(docs, shingle=5, percent=80).where("kept").select("doc_id", "text_key").distinct()
    # The input is one struct column meanwhile, so that its names don't matter.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.md5(F.coalesce("text", F.lit(""))).alias("key"))
    same = rows["id"].eqNullSafe(kept["doc_id"]) & (rows["key"] == kept["text_key"])
    first = F.min(F.struct(*[f"row.`{c}`" for c in sorted(docs.columns, key=lambda c: c == "text")])).alias("row")
    one = rows.join(kept, same, "left_semi").groupBy("id", "key").agg(first)
    return one.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go, however short the item is."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are cut or repeated to their target weights."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records in the shared folder, and where each one is."""
    ship_package(spark)
    path, pattern = tokenizer_files()
    return records.token_records(docs, path, pattern, END_ID, added=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

#: SQL can't express the classifier or the tokenizer; tests use a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
