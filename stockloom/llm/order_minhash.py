"""Order MinHash fingerprints, sensitive to edit distance.

A text is cut into units (runs of other than white space, at most 16 characters
long; ideographs, kana and Hangul one by one).  Its k-mers are k units in a row;
a k-mer that occurs again carries its occurrence number, so all are distinct.
For each of m random orders the l least numbered k-mers are taken, put back into
text order, and hashed as a tuple.  A moved or changed passage alters both which
k-mers are least and the order they stand in.

All of it is column expressions.  The m orders are the m ways of flipping the
leading bits of one hash: each is a uniform order by itself, and one sorted
array serves all of them, since the least values of an order are the first ones
of a bucket.  Where a bucket holds fewer than l values, that order is sorted in
full.  Arrays hold (hash, position) in one number; equal k-mers stand side by
side in the sorted array, which gives their occurrence numbers in linear time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import in_ranges, text_key, with_neighbours
from stockloom.session import materialise

K, L, M_BITS = 3, 2, 5
_EAST = r"⺀-鿿가-힯豈-﫿"
UNIT = rf"[{_EAST}]|[^\s{_EAST}]{{1,16}}"
_POSITION = (1 << 31) - 1
_HASH = (1 << 32) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _packed(hash_: Column, position: Column) -> Column:
    """32 bits of a hash above 31 bits of a position: never negative."""
    return F.shiftleft(hash_.bitwiseAND(F.lit(_HASH)), 31).bitwiseOR(position.cast("long"))


def _position(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_POSITION))


def kmers(text: Column, k: int = K) -> Column:
    """Hashes of the k-mers in text order; the last k - 1 are shorter."""
    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0))

    def grow(words: Column) -> Column:
        out = words
        for i in range(2, k + 1):
            out = F.zip_with(out, F.slice(words, F.lit(i), F.greatest(F.size(words) - (i - 1), F.lit(0))), lambda a, b: F.xxhash64(a, b))
        return out

    return _let(F.transform(units, lambda w: F.xxhash64(w)), grow)


def _numbered(found: Column) -> Column:
    """Sorted (hash, position) of k-mers to (hash with occurrence number, position)."""
    def number(s: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(s) - 1)
        heads = F.filter(at, lambda i: (i == 0) | (F.shiftright(F.get(s, i), 31) != F.shiftright(F.get(s, i - 1), 31)))

        def one(x: Column, occurrence: Column) -> Column:
            return _packed(F.xxhash64(F.shiftright(x, 31), occurrence), _position(x))

        def runs(starts: Column) -> Column:
            return F.flatten(F.transform(starts, lambda b, r: F.transform(
                F.sequence(b, F.coalesce(F.get(starts, r + 1), F.size(s)) - 1), lambda i: one(F.get(s, i), i - b))))

        return _let(heads, lambda starts: F.when(
            F.size(starts) == F.size(s), F.transform(s, lambda x: one(x, F.lit(0)))).otherwise(runs(starts)))

    return F.when(F.size(found) == 0, found).otherwise(_let(found, number))


def _sketch(numbered: Column, found: Column, l: int, m_bits: int) -> Column:  # noqa: E741
    """The m tuple hashes; an empty array for a text without k-mers."""
    drop = 63 - m_bits

    def tuples(values: Column, mers: Column) -> Column:
        def choose(buckets: Column) -> Column:
            def order(j: Column) -> Column:
                start = F.array_position(buckets, j)
                mask = F.shiftleft(j.cast("long"), drop)
                least = F.when((start > 0) & (F.get(buckets, (start + (l - 2)).cast("int")) == j),
                               F.slice(values, F.greatest(start, F.lit(1)).cast("int"), F.lit(l)))
                full = F.slice(F.sort_array(F.transform(values, lambda x: x.bitwiseXOR(mask))), 1, l)
                places = F.sort_array(F.transform(F.coalesce(least, full), _position))
                tuple_hash = F.aggregate(places, F.lit(42).cast("long"), lambda h, p: F.xxhash64(h, F.get(mers, p.cast("int"))))
                return F.shiftright(F.shiftleft(tuple_hash, 32), 32).cast("int")

            return F.transform(F.sequence(F.lit(0), F.lit((1 << m_bits) - 1)), order)

        return _let(F.transform(values, lambda x: F.shiftright(x, drop).cast("int")), choose)

    empty = F.array().cast("array<int>")
    return F.when(F.size(numbered) == 0, empty).otherwise(
        _let(numbered, lambda v: _let(found, lambda m: tuples(v, m))))


def with_order_minhash(df: DataFrame, text_col: str, out_col: str, k: int = K, l: int = L, m_bits: int = M_BITS) -> DataFrame:  # noqa: E741
    """``df`` with an array of 2^m_bits integers; empty for a text without units.

    A null text is empty.  Equal texts have equal fingerprints.  ``df`` must not
    have ``out_col`` or columns that begin with ``_omh``.
    """
    found = df.withColumn("_omh_k", kmers(F.col(text_col), k))
    packed = found.withColumn("_omh_s", F.sort_array(F.transform("_omh_k", lambda h, i: _packed(h, i))))
    numbered = packed.withColumn("_omh_n", F.sort_array(_numbered(F.col("_omh_s"))))
    return numbered.withColumn(out_col, _sketch(F.col("_omh_n"), F.col("_omh_k"), l, m_bits)).drop("_omh_k", "_omh_s", "_omh_n")


def likeness(a: str, b: str) -> Column:
    """Share of equal coordinates; 1 for two empty texts, 0 if one is empty."""
    x, y = F.col(a), F.col(b)
    same = F.size(F.filter(F.zip_with(x, y, lambda p, q: p == q), lambda e: e)) / F.size(x)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), (F.size(x) == F.size(y)).cast("double")).otherwise(same)


def as_text(fingerprint: str) -> Column:
    """Eight hexadecimal digits per coordinate."""
    word = F.transform(fingerprint, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(_HASH))), 8, "0"))
    return F.lower(F.array_join(word, ""))


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 4) -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses.

    The edited text has its last floor(n / ``share``) code points replaced by the
    first as many of the next document in ascending id (after the last: the
    first; with one document: itself).  Null ids come first; rows of one id are
    ordered by a digest of their text; repeated rows count as one document and
    each gets its result.  Columns: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.  Other columns are ignored.
    """
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     text_key(id_col, text_col).alias("key"))
    listed = docs.select("id", "key", F.char_length("text").alias("n")).groupBy("id", "key").agg(F.first("n").alias("n"))
    order = ["id", "key"]
    ring = materialise(
        with_neighbours(in_ranges(listed, [*order, "n"], "omh-order"), [*order, "n"], around=True)
        .select("key", "id", F.col("previous.key").alias("previous_key"), F.col("next.key").alias("next_key"),
                F.floor(F.col("previous.n") / share).cast("int").alias("wanted"),
                F.floor(F.col("n") / share).cast("int").alias("cut")), "omh-ring")
    # Only the heads that an edit needs move to the document before.  Both uses
    # of the texts read the same columns, so they are shuffled once.
    placed = docs.select("key", "text").join(ring, "key")
    heads = placed.select(F.col("previous_key").alias("key"), F.substring("text", F.lit(1), F.col("wanted")).alias("head")) \
        .groupBy("key").agg(F.first("head").alias("head"))
    n = F.char_length("text")
    both = (placed.join(heads, "key")
            .withColumn("n_chars", n.cast("long"))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), n - F.col("cut")), "head"))
            .select("id", "key", "next_key", "n_chars", "text", "edited", F.sha2("edited", 256).alias("edited_sha256")))
    prints = with_order_minhash(with_order_minhash(both, "text", "fp"), "edited", "edited_fp").drop("text", "edited")
    prints = materialise(prints, "omh-prints")
    after = prints.select(F.col("key").alias("next_key"), F.col("fp").alias("next_fp")).groupBy("next_key").agg(F.first("next_fp").alias("next_fp"))
    return prints.join(after, "next_key").select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", as_text("fp").alias("fingerprint"),
        as_text("edited_fp").alias("edited_fingerprint"), likeness("fp", "edited_fp").alias("near_edited"),
        likeness("fp", "next_fp").alias("near_next"))
