"""URL rules in a sorted array of digests.

Rules are written as one artefact in the shared folder: 64-bit xxhash keys in
ascending order, the rules' texts in the same order, and their offsets.
Executors get it through Spark's file distribution and memory-map the keys.  A batch of URLs gives the
keys of every host suffix joined with every path prefix of a length that some
rule has; they are found by vectorised binary search, and the stored text
decides, so that two texts of one digest cannot be confused.

An artefact holds at most ``block_rules`` rules.  A longer list becomes several
artefacts by digest, probed one after the other over the same rows, each pass
improving the match found so far; no task holds more than one block, and the
driver holds none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm.common import with_python
from stockloom.session import stage_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_host(url: str) -> Column:
    host = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def url_path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class DigestArray:
    """One artefact: memory-mapped keys, verdicts and texts."""

    def __init__(self, path: str):
        count, lengths = np.fromfile(path, "<u8", 2).tolist()
        at = 16
        self.keys = np.memmap(path, "<u8", "r", at, (count,)) if count else np.empty(0, "<u8")
        at += 8 * count
        self.starts = np.memmap(path, "<u8", "r", at, (count + 1,))
        at += 8 * (count + 1)
        self.path_lengths = np.fromfile(path, "<u8", lengths, offset=at).tolist()
        at += 8 * lengths
        self.blocked = np.memmap(path, "u1", "r", at, (count,)) if count else np.empty(0, "u1")
        at += count
        size = int(self.starts[-1])
        self.texts = np.memmap(path, "u1", "r", at, (size,)) if size else np.empty(0, "u1")

    @staticmethod
    def build(rules: list[tuple[str, bool]]) -> bytes:
        """``rules``: distinct host-and-path texts, and whether each blocks."""
        encoded = [(xxhash.xxh64_intdigest(r.encode()), r.encode(), b) for r, b in rules]
        encoded.sort()
        lengths = sorted({len(r) - r.index("/") for r, _ in rules})
        return b"".join([
            np.array([len(rules), len(lengths)], "<u8").tobytes(),
            np.array([k for k, _, _ in encoded], "<u8").tobytes(),
            np.concatenate([[0], np.cumsum([len(r) for _, r, _ in encoded])]).astype("<u8").tobytes(),
            np.array(lengths, "<u8").tobytes(),
            bytes(b for _, _, b in encoded),
            *[r for _, r, _ in encoded]])

    def text(self, i: int) -> bytes:
        return self.texts[int(self.starts[i]):int(self.starts[i + 1])].tobytes()

    def find(self, candidates: list[bytes]) -> np.ndarray:
        """Position of each candidate's rule, -1 where there is none."""
        keys = np.fromiter(map(xxhash.xxh64_intdigest, candidates), "<u8", len(candidates))
        at = np.searchsorted(self.keys, keys)
        out = np.full(len(candidates), -1)
        hit = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, max(0, len(self.keys) - 1))] == keys)) if len(self.keys) else []
        for j in hit:
            i = int(at[j])
            while i < len(self.keys) and self.keys[i] == keys[j]:  # rules of one digest stand side by side
                if self.text(i) == candidates[j]:
                    out[j] = i
                    break
                i += 1
        return out


def candidates_of(host: str, path: str, path_lengths: list[int]) -> list[str]:
    """Host suffixes at dots x path prefixes of the given lengths, longest first."""
    if not host:
        return []
    prefixes = [path[:n] for n in reversed(path_lengths) if n <= len(path)]
    suffixes = [host, *[host[m.end():] for m in re.finditer(r"\.", host)]]
    return sorted((s + p for s in suffixes if s for p in prefixes), key=lambda c: (-len(c), c))


_mapped: dict[str, DigestArray] = {}


def _artefact(name: str) -> DigestArray:
    if name not in _mapped:
        _mapped[name] = DigestArray(SparkFiles.get(name))
    return _mapped[name]


def _ship(spark: SparkSession, rules: DataFrame) -> list[str]:
    """Writes one block to the shared folder and has Spark bring it to every
    executor; the file's name, or nothing for a block without rules."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(r["rule"], r["blocked"]) for b in batches for r in b.to_pylist()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([DigestArray.build(found)], pa.binary())], ["value"])

    path = stage_path(spark, "url-rules")
    one = rules.repartition(1).mapInArrow(build, "value binary")  # at most one block
    one.select(F.col("value").cast("string")).write.text(path)
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path").collect()
    for f in files:
        spark.sparkContext.addFile(f["path"])
    return [f["path"].rsplit("/", 1)[1] for f in files]


def url_verdicts(df: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 default: str = "allow", block_rules: int = 2_000_000) -> DataFrame:
    """One row per row of ``df``: id, host, path, rule, verdict.

    ``rules`` has columns rule (host and path prefix, the host in lower case)
    and verdict (block or allow).  A rule fits its host and all subdomains if
    the path starts with the rule's path.  The longest rule wins, between equal
    lengths the first in code point order.  A rule given with both verdicts
    blocks; null rules and rules without a slash are left out.  A URL that is
    null or has no ``://`` has neither host nor path and gets ``default``, as
    does one that no rule fits.
    """
    spark = df.sparkSession
    known = (rules.where("rule is not null and instr(rule, '/') > 0").groupBy("rule")
             .agg(F.max(F.col("verdict") == "block").alias("blocked")))
    blocks = max(1, -(-known.count() // block_rules))
    out = df.select(F.col(id_col), url_host(url_col).alias("host"), url_path(url_col).alias("path"),
                    F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for block in range(blocks):
        part = known.where(F.pmod(F.xxhash64("rule"), F.lit(blocks)) == block)
        names = _ship(spark, part)
        if not names:
            continue

        def probe(b: pa.RecordBatch, name: str = names[0]) -> dict[str, list]:
            array = _artefact(name)
            hosts, paths, best, verdicts = (b.column(c).to_pylist() for c in ("host", "path", "rule", "verdict"))
            tried = [candidates_of(h, p, array.path_lengths) for h, p in zip(hosts, paths)]
            at = array.find([c.encode("utf-8", "surrogatepass") for cs in tried for c in cs])
            k = 0
            for i, cs in enumerate(tried):
                hits = [(c, int(j)) for c, j in zip(cs, at[k:k + len(cs)]) if j >= 0]
                k += len(cs)
                if hits and (best[i] is None or (-len(hits[0][0]), hits[0][0]) < (-len(best[i]), best[i])):
                    best[i] = hits[0][0]
                    verdicts[i] = "block" if array.blocked[hits[0][1]] else "allow"
            return {"rule": best, "verdict": verdicts}

        out = with_python(out, probe, "rule string, verdict string", drop=("rule", "verdict"))
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
