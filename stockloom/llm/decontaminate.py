"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is contained in a document if enough of the item's distinct shingles
occur in it.  Items are partitioned by their number of shingles; the signature
of an item is the bottom sketch of its shingle hashes, its k least ones, where k
is one more than the number of shingles that the largest item of its partition
may miss.  A document that contains the item holds at least one hash of the
signature, however long it is, so the search misses nothing.  Candidates are
verified by the exact containment of the shingles themselves.

The items' side is cut into blocks of bounded size, each probed against all
documents, so what is sent to executors does not grow with either table.
Documents are not shuffled.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import mix, plain_units, where_python, with_python

#: Upper ends of the size partitions, in shingles; larger items have their own.
SIZES = (8, 16, 24, 32, 48, 64, 96, 128, 192, 256, 512, 1024)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles_of(text: str | None, size: int) -> list[tuple[str, ...]]:
    """Word shingles in order; a shorter text is one shingle, no words none."""
    t = plain_units(text)
    return [tuple(t[i:i + size]) for i in range(max(1, len(t) - size + 1))] if t else []


class Items:
    """One block of items: shingle numbers, signatures, and their postings."""

    def __init__(self, items: list[tuple[int | None, str]], size: int, percent: int):
        self.size, self.percent = size, percent
        self.words: dict[str, int] = {}
        self.sets: list[set[tuple[int, ...]]] = []
        self.members: list[list[int]] = []
        by_set: dict[frozenset, int] = {}
        for item_id, text in items:
            found = {tuple(self.words.setdefault(w, len(self.words) + 1) for w in s) for s in shingles_of(text, size)}
            if not found:
                continue
            key = frozenset(found)
            if key not in by_set:  # items of equal shingles are searched once
                by_set[key] = len(self.sets)
                self.sets.append(found)
                self.members.append([])
            self.members[by_set[key]].append(item_id)
        self.signature: dict[int, list[int]] = {}
        for n, found in enumerate(self.sets):
            upper = SIZES[bisect_left(SIZES, len(found))] if len(found) <= SIZES[-1] else len(found)
            k = min(len(found), upper - -(-percent * upper // 100) + 1)
            for h in sorted(self.hash_of(s) for s in found)[:k]:
                self.signature.setdefault(h, []).append(n)
        self.keys = np.array(sorted(self.signature), np.uint64)
        self.lengths = sorted({len(s) for found in self.sets for s in found})

    def hash_of(self, shingle: tuple[int, ...]) -> int:
        return int(self.hashes(np.array(shingle, np.uint64), len(shingle))[0])

    @staticmethod
    def hashes(words: np.ndarray, length: int) -> np.ndarray:
        """Hashes of all runs of ``length`` word numbers."""
        h = np.full(len(words) - length + 1, np.uint64(length))
        for i in range(length):
            h = mix(h * _STEP + words[i:i + len(h)])
        return h

    def search(self, text: str | None) -> list[dict[str, int]]:
        """Item, number of its shingles and of those found, for the items that the text contains."""
        tokens = plain_units(text)
        get = self.words.get
        words = np.array([get(t, 0) for t in tokens], np.uint64)
        hit: set[int] = set()
        seen: set[tuple[int, ...]] = set()
        for length in self.lengths:
            if not 0 < length <= len(words) or not len(self.keys):
                continue
            full = np.flatnonzero(np.convolve(words != 0, np.ones(length, int), "valid") == length)  # runs of known words
            if not len(full):
                continue
            h = self.hashes(words, length)[full]
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            new = {n for key in np.unique(h[self.keys[at] == h]).tolist() for n in self.signature[key]}
            if new:
                hit |= new
                seen.update(tuple(words[i:i + length].tolist()) for i in full)
        out = []
        if hit:
            for n in sorted(hit):
                both = len(self.sets[n] & seen)
                if 100 * both >= self.percent * len(self.sets[n]):
                    out += [{"item_id": item, "item_shingles": len(self.sets[n]), "found_shingles": both} for item in self.members[n]]
        return out


def _blocks(items: DataFrame, id_col: str, text_col: str, block_items: int, block_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks, by hash, of about ``block_items`` rows and
    ``block_bytes`` bytes of text at most; null ids last."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    count, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-count // block_items), -(-size // block_bytes))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        yield sorted(((r["id"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def contaminated_pairs(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", size: int = 5, percent: int = 80,
                       block_items: int = 50_000, block_bytes: int = 1 << 24) -> DataFrame:
    """(doc_id, item_id, item_shingles, found_shingles, containment): every item
    of which a document holds at least ``percent`` of the distinct shingles.

    Words are lower-cased runs of letters and digits, so punctuation and line
    breaks do not matter; ideographs, kana and Hangul are words of their own.
    Null and wordless texts contain nothing and are contained in nothing.  An
    item of fewer words than a shingle is one shingle, found wherever a document
    holds these words in a row.  Items without id are items too.  Repeated rows
    give repeated results.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text"))
    out = None
    for block in _blocks(items, item_id, item_text, block_items, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(Items(block, size, percent))

        def search(b: pa.RecordBatch, shared=shared) -> dict[str, list]:
            return {"found": [shared.value.search(t) for t in b.column("text").to_pylist()]}

        kind = "array<struct<item_id: long, item_shingles: long, found_shingles: long>>"
        part = with_python(rows, search, f"found {kind}", drop=("text",)).select("doc_id", F.inline("found"))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("containment", F.col("found_shingles") / F.col("item_shingles"))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_text: str = "text", item_id: str = "item_id",
                      item_text: str = "text", size: int = 5, percent: int = 80, block_items: int = 50_000,
                      block_bytes: int = 1 << 24) -> DataFrame:
    """The rows of ``docs`` that contain no item by the definition of
    ``contaminated_pairs``; all columns as they are."""
    for block in _blocks(items, item_id, item_text, block_items, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(Items(block, size, percent))

        def clean(b: pa.RecordBatch, shared=shared) -> list[bool]:
            return [not shared.value.search(t) for t in b.column(doc_text).to_pylist()]

        docs = where_python(docs, clean)
    return docs
