"""Mixing sources to target weights by hash thresholds.

Each source has a budget of words.  A document's copies are the whole passes the
budget allows plus one if its hash is at most the source's threshold.  The
threshold is found from histograms of words by source and hash digit: the first
histogram covers every document, each later one only the bucket in which the
budget ends, until a single hash value is left.  Nothing is sorted, a source's
rows are never gathered, and choosing is a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.llm.common import WORD, text_key
from stockloom.session import materialise

HASH_BITS, DIGIT_BITS = 48, 12


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def hash_value(key: Column) -> Column:
    """The first 48 bits of a hexadecimal digest as a whole number."""
    return F.conv(F.substring(key, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources in code point order, null last, take the weights in turn.  A target
    stops at ``most`` times its source's size and the excess goes to the others
    by weight: with sources ordered by size over weight, those up to some point
    stop and the rest share what is left by one rate.  One row per source.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    listed = sizes.withColumn("turn", F.row_number().over(turn) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int")))
    order = Window.orderBy(F.col("full") / F.col("weight"), "turn")
    rates = (listed.withColumn("full", most * F.col("source_size"))
             .withColumn("goal", share * F.sum("source_size").over(Window.partitionBy()))
             .withColumn("stopped", F.coalesce(F.sum("full").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             .withColumn("open", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
             .withColumn("place", F.row_number().over(order))
             .withColumn("rate", (F.col("goal") - F.col("stopped")) / F.col("open")))
    fits = F.when(F.col("rate") * F.col("weight") <= F.col("full"), F.struct("place", "rate"))
    rate = F.min(fits).over(Window.partitionBy())["rate"]
    return rates.withColumn("common", rate).select(
        "source", "source_size",
        F.when(F.col("common").isNull(), F.col("full")).otherwise(F.least("full", F.col("common") * F.col("weight"))).alias("target"))


def _thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, passes, rest) to (source, passes, threshold), -1 for none.

    ``threshold`` is the hash up to which the words come nearest to ``rest``.
    """
    found = budgets.select("source", "passes", "rest", F.lit(0.0).alias("below"), F.lit(0).cast("long").alias("head"))
    same = "d.source <=> b.source"
    for shift in range(HASH_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        inside = (docs.alias("d").join(found.alias("b"), F.expr(f"{same} and shiftright(d.u, {shift + DIGIT_BITS}) = b.head"))
                  .select("b.*", F.shiftright(F.col("d.u"), shift).alias("digit"), "d.size"))
        bars = inside.groupBy("source", "passes", "rest", "below", "digit").agg(F.sum("size").alias("bar"))
        run = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        bars = bars.withColumn("start", F.col("below") + F.coalesce(F.sum("bar").over(run), F.lit(0)))
        # The bucket in which the budget ends: the last one that starts at or below it.
        last = bars.where("start <= rest").groupBy("source", "passes", "rest").agg(
            F.max(F.struct("digit", "start", "bar")).alias("at"))
        found = materialise(last.select("source", "passes", "rest", F.col("at.start").alias("below"),
                                        F.col("at.digit").alias("head"), F.col("at.bar").alias("bar")), "mix-level")
    take = F.col("below") + F.col("bar") - F.col("rest") < F.col("rest") - F.col("below")
    return found.select("source", "passes", F.when(take, F.col("head")).otherwise(F.col("head") - 1).alias("threshold"))


def plan_mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(documents, sources): narrow rows with their hash, and per source its
    size, target, whole passes and hash threshold."""
    docs = materialise(df.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
        hash_value(text_key(id_col, text_col)).alias("u")), "mix-rows")
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(source_targets(sizes, weights, share, most), "mix-targets")
    budgets = targets.select(
        "source", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("passes"),
        (F.col("target") - F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0) * F.col("source_size")).alias("rest"))
    cuts = _thresholds(docs, budgets)
    sources = targets.alias("t").join(cuts.alias("c"), F.expr("t.source <=> c.source")).select("t.*", "passes", "threshold")
    return docs, materialise(sources, "mix-sources")


def _copies() -> Column:
    return F.col("passes") + (F.col("u") <= F.col("threshold")).cast("long")


def mix_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per document: id, size, source_size, target, taken, copies.

    A null source is a source of its own, the last one.  A null or empty text
    has size 0 and nothing is taken of it.  Equal (id, text) rows have one hash
    and are taken or left together.  Documents are taken whole, so a source
    comes as near to its target as the document at the boundary lets it.
    """
    docs, sources = plan_mix(df, id_col, text_col, source_col, weights, share, most)
    return (docs.alias("d").join(sources.alias("s"), F.expr("d.source <=> s.source"))
            .select(F.col("d.id").alias(id_col), "size", "source_size", "target", _copies().alias("copies"))
            .withColumn("taken", F.col("size") * F.col("copies")))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it; rows without words go."""
    _, sources = plan_mix(df, id_col, text_col, source_col, weights, share, most)
    cuts = sources.select(F.struct(F.col("source").alias("source"), "passes", "threshold").alias("_cut"))
    u = hash_value(text_key(id_col, text_col))
    joined = df.join(cuts, F.col(source_col).eqNullSafe(F.col("_cut.source")))
    times = F.col("_cut.passes") + (u <= F.col("_cut.threshold")).cast("long")
    return (joined.where(word_count(text_col) > 0).withColumn("_times", times)
            .where("_times > 0").withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times"))))
            .select(*[df[c] for c in df.columns]))
