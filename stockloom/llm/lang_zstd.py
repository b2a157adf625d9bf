"""Language by compression.

Each language has a raw-content dictionary: pieces of texts of that language,
laid end to end.  A text is compressed once with every dictionary; the language whose
dictionary gives the smallest result is chosen, and the gap to the second
smallest is the confidence.  Texts are lower-cased first, and cut into pieces so that a dictionary
keeps helping throughout a long text; all pieces count.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import with_python

PIECE = 512
LEVEL = 6


def learn_dictionaries(df: DataFrame, text_col: str, lang_col: str, dict_bytes: int = 200_000,
                       piece: int = 2_000, key_col: str | None = None) -> dict[str, bytes]:
    """Raw-content dictionaries from a bounded sample of labelled rows.

    Texts of any length are cut into pieces of ``piece`` characters; a language's
    dictionary is about ``dict_bytes`` of the pieces of least hashes, the same
    bound at every corpus size.  Every language with a text that is not empty is
    learned.
    """
    fit = df.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.length(text_col).alias("n"),
        F.xxhash64(*([key_col] if key_col else []), text_col).alias("row_hash"))
    sizes = fit.groupBy("lang").agg(F.sum("n").alias("chars"), F.min("row_hash").alias("least")).collect()  # one row per language
    if not sizes:
        return {}

    def place_hash(at: Column) -> Column:
        return F.pmod(F.xxhash64("row_hash", at), F.lit(1 << 30))

    def pieces(rows: DataFrame, chosen: Callable[[Column], Column]) -> DataFrame:
        # Places are chosen before the text is cut, so long texts are not copied once a piece.
        places = F.filter(F.sequence(F.lit(1), F.col("n"), F.lit(piece)), chosen)
        cut = F.transform(places, lambda at: F.struct(place_hash(at).alias("h"), F.col("text").substr(at, F.lit(piece)).alias("text")))
        return rows.select("lang", F.inline(cut)).distinct()

    share = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 2.0 * dict_bytes / r["chars"]))) for r in sizes])
    rows = pieces(fit, lambda at: place_hash(at) < share * (1 << 30)).collect()  # about 2 * dict_bytes a language
    missed = [r for r in sizes if r["lang"] not in {x["lang"] for x in rows}]
    if missed:  # by chance no place was chosen; the first piece of one row each
        first = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.col("row_hash") == r["least"]) for r in missed], F.lit(False))
        rows += pieces(fit.where(first), lambda at: at == 1).collect()
    out: dict[str, bytes] = {}
    for lang in sorted({r["lang"] for r in sizes}):
        pool, seen = b"", set()
        for r in sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["h"], r["text"])):
            if r["text"] not in seen and len(pool) < dict_bytes:
                seen.add(r["text"])
                pool += r["text"].lower().encode("utf-8", "surrogatepass") + b"\n"
        if pool:
            out[lang] = pool
    return out


_compressors: dict[bytes, zstandard.ZstdCompressor] = {}


def _compressor(pool: bytes) -> zstandard.ZstdCompressor:
    if pool not in _compressors:
        data = zstandard.ZstdCompressionDict(pool, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        _compressors[pool] = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False)
    return _compressors[pool]


def sizes_of(text: str, pools: list[bytes]) -> list[int]:
    data = text.lower().encode("utf-8", "surrogatepass")
    pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
    return [sum(len(c.compress(p)) for p in pieces) for c in map(_compressor, pools)]


def predict_language(df: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text",
                     narrow: float = 0.01) -> DataFrame:
    """``df`` without its text, with lang_pred, score (0 to 1) and rejected.

    ``score`` is twice the share by which the smallest size undercuts the second
    smallest, at most 1; ``rejected`` marks scores below ``narrow``.  A null
    text, one without a letter, and any text if nothing was learned is ``und``
    with score 0, rejected.  With one language learned the score is 1.  Between
    equal sizes the first language in code point order is taken.
    """
    langs = sorted(dictionaries)
    shared = df.sparkSession.sparkContext.broadcast([dictionaries[x] for x in langs])  # languages x dict_bytes

    def predict(b: pa.RecordBatch) -> dict[str, list]:
        pools, found = shared.value, []
        for text in b.column(text_col).to_pylist():
            if not langs or text is None or not any(map(str.isalpha, text)):
                found.append(("und", 0.0, True))
                continue
            sizes = sizes_of(text, pools)
            best = min(range(len(langs)), key=lambda i: (sizes[i], i))
            rest = min((s for i, s in enumerate(sizes) if i != best), default=None)
            score = 1.0 if rest is None else min(1.0, 2.0 * (rest - sizes[best]) / rest)
            found.append((langs[best], score, score < narrow))
        return {n: [f[i] for f in found] for i, n in enumerate(("lang_pred", "score", "rejected"))}

    return with_python(df.drop("lang_pred", "score", "rejected"), predict,
                       "lang_pred string, score double, rejected boolean", drop=(text_col,))
