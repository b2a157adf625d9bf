import pytest

from stockloom.llm import common  # noqa: F401


@pytest.fixture
def docs(spark):
    """Builds a documents frame from (doc_id, text[, lang, source]) rows."""
    def make(rows, extra=False):
        full = [(*r, *("en", "src0")[len(r) - 2:], len(r[1] or "")) if len(r) < 4 else (*r, len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        if extra:  # names that operators use inside
            for name in ("id", "key", "part", "node", "size", "u", "row", "score", "kept", "shard", "n_shingles"):
                from pyspark.sql import functions as F
                df = df.withColumn(name, F.lit("x"))
        return df
    return make
