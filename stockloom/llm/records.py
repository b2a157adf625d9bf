"""Length-delimited binary token records with a separate offset index.

A file is a run of frames, in ascending document order:

    length   8 bytes   of the body, little-endian
    check    4 bytes   masked CRC of the length bytes
    body     id flag (1 byte, 0: null), id (8 bytes), width (1 byte), token ids
    check    4 bytes   masked CRC of the body
    end      1 byte    a line feed, written by Spark's text writer

Token ids take two bytes where the largest id fits, else four (``width``).
The mask rotates the CRC by 15 bits and adds a constant, so that a checksum of
data that holds checksums stays meaningful.  Spark's committer names the files,
so a task that is run again leaves no half-written file behind.  The index is
built by reading the files back: path, offset and length of each record, enough
to read any record alone, in any order.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import tasks_of
from stockloom.session import stage_path

HEAD = struct.Struct("<QI")
BODY = struct.Struct("<?qB")
MASK_DELTA = 0xA282EAD8
#: Bytes of encoded units that a worker keeps by default, with about what an entry takes
#: besides its characters; longer units are encoded each time.
CACHE_BYTES, ENTRY_BYTES, UNIT_CHARS = 40 << 20, 150, 64
#: Marks that end a word and are a piece of their own there.
MARKS = ".,;:!?)"
#: The characters that stand for the 256 bytes in a byte-level vocabulary: printable ones stay.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARS = {b: chr(b if b in _PRINTED else 256 + sum(c not in _PRINTED for c in range(b))) for b in range(256)}
#: White space by anyone's definition; a space beside it is no safe place to cut.
BLANKS = "".join(c for c in map(chr, range(0x10000)) if c.isspace()) + "\u180e"
_SAFE = re.compile(f"(?<![{BLANKS}]) (?![{BLANKS}])")
#: A space beside another white space character.
_CROWDED = f" [{BLANKS}]|[{BLANKS}] "


def cut_at_spaces(texts: pa.Array) -> pa.Array:
    """The lists of units between the safe spaces of each text."""
    crowded = pc.match_substring_regex(texts, _CROWDED).to_numpy(zero_copy_only=False)
    if not crowded.any():
        return pc.split_pattern(texts, " ")
    plain = pc.split_pattern(texts.filter(pa.array(~crowded)), " ")
    other = pa.array([_SAFE.split(t) for t in texts.filter(pa.array(crowded)).to_pylist()], plain.type)
    at = np.where(crowded, len(plain) + np.cumsum(crowded) - 1, np.cumsum(~crowded) - 1)
    return pa.concat_arrays([plain, other]).take(pa.array(at))


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    """One frame without its end byte."""
    body = BODY.pack(doc_id is not None, doc_id or 0, width) + ids.astype(f"<u{width}").tobytes()
    size = struct.pack("<Q", len(body))
    return size + struct.pack("<I", masked_crc(size)) + body + struct.pack("<I", masked_crc(body))


def read_frame(data, offset: int = 0) -> tuple[int | None, np.ndarray, int]:
    """(id, token ids, offset of the next frame); raises on a wrong checksum."""
    size, check = HEAD.unpack_from(data, offset)
    if masked_crc(bytes(data[offset:offset + 8])) != check:
        raise ValueError(f"length check failed at offset {offset}")
    start = offset + HEAD.size
    body = bytes(data[start:start + size])
    (check,) = struct.unpack_from("<I", data, start + size)
    if masked_crc(body) != check:
        raise ValueError(f"body check failed at offset {offset}")
    known, doc_id, width = BODY.unpack_from(body)
    return doc_id if known else None, np.frombuffer(body, f"<u{width}", offset=BODY.size), start + size + 5


class Encoder:
    """Encodes whole texts with a byte-level BPE file of the tokenizers library.

    Such a tokenizer cuts a text by ``pattern`` and encodes each piece by
    itself.  A single space between two characters that aren't white space always
    begins a piece, so texts are cut there, and units met before come from a
    table bounded in bytes.  A new unit that is a word, or a word and a
    mark at its end, needs no pattern: these are its pieces.  Arrow cuts the
    texts, numbers the units and puts their ids together, so that Python sees
    each unit once per call, however often it stands in the texts.

    With ``added`` a string of an added token in a text is that token, as the
    library has it by default: texts that hold such a string go to the library
    whole.  Without, such strings are ordinary text.
    """

    def __init__(self, path: str, pattern: str, added: bool = False, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer

        self.path, self.cache_bytes = path, cache_bytes
        library = Tokenizer.from_file(path)
        self.added = [t.content for t in library.get_added_tokens_decoder().values()] if added else []
        self.tokenize, self.normalizer = library.model.tokenize, library.normalizer
        self.width = 2 if library.get_vocab_size() <= 1 << 16 else 4
        self.pieces_of = regex.compile(pattern).findall
        self.marks = self._ids(list(MARKS))
        #: Ids of units that follow a space.
        self.units: dict[str, bytes] = {}
        self.held = self.missed = 0

    @cached_property
    def whole(self):
        """The tokenizer as its file gives it; few texts need it, so it is read then."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _ids(self, pieces: list[str], before: str = "") -> dict[str, bytes]:
        """Ids of pieces by the library's model, which takes them as the characters of their bytes."""
        tokenize, code, out = self.tokenize, "H" if self.width == 2 else "I", {}
        for p in pieces:
            whole = before + p
            if self.normalizer:
                whole = self.normalizer.normalize_str(whole)
            ids = [t.id for t in tokenize(whole.encode().decode("latin-1").translate(BYTE_CHARS))]
            out[p] = struct.pack(f"<{len(ids)}{code}", *ids)
        return out

    def _cut(self, units: list[str]) -> list[bytes]:
        """Ids of units that the pattern has to cut."""
        cut = [self.pieces_of(u) for u in units]
        ids = {p: self.units.get(p[1:]) if p[:1] == " " and p[1:].isalpha() else None for ps in cut for p in ps}
        ids.update(self._ids([p for p, known in ids.items() if known is None]))
        return [b"".join([ids[p] for p in ps]) for ps in cut]

    def _learn(self, units: list[str]) -> dict[str, bytes]:
        """Ids of units that follow a space."""
        known, words, marked, other = self.units, set(), [], []
        for u in units:
            if u.isalpha():
                words.add(u)
            elif u[-1:] in self.marks and u[:-1].isalpha():
                marked.append(u)
                if u[:-1] not in known:
                    words.add(u[:-1])
            else:
                other.append(u)
        new = self._ids(list(words), " ")
        new.update(zip(other, self._cut([" " + u for u in other])))
        for u in marked:
            new[u] = (new.get(u[:-1]) or known[u[:-1]]) + self.marks[u[-1]]
        self._keep(new)
        return new

    def _keep(self, new: dict[str, bytes]) -> None:
        if self.held < self.cache_bytes:
            kept = {u: ids for u, ids in new.items() if len(u) <= UNIT_CHARS}
            self.units.update(kept)
            self.held += sum(map(len, kept)) + sum(map(len, kept.values())) + ENTRY_BYTES * len(kept)
            return
        self.missed += len(new)
        if self.missed > 8 * len(self.units):  # the texts have become others
            self.units.clear()
            self.held = self.missed = 0

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        holding = np.zeros(len(texts), bool)
        for c in self.added:
            holding |= pc.match_substring(texts, c).to_numpy(zero_copy_only=False)
        if not holding.any():
            return self._encode(texts)
        rest = iter(self._encode(texts.filter(pa.array(~holding))))
        return [np.array(self.whole.encode(t.as_py(), add_special_tokens=False).ids, f"<u{self.width}") if h else next(rest)
                for t, h in zip(texts, holding)]

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        cuts = cut_at_spaces(texts)
        units, starts = cuts.flatten(), np.concatenate([[0], np.cumsum(cuts.value_lengths().to_numpy())])
        first = np.zeros(len(units), bool)  # a first unit follows no space
        first[starts[:-1]] = True
        heads = self._cut(units.filter(pa.array(first)).to_pylist())
        later = units.filter(pa.array(~first)).dictionary_encode()
        ids = pa.array(heads + self._ids_of(later.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        which = np.empty(len(units), np.int64)
        which[first] = np.arange(len(heads))
        which[~first] = later.indices.to_numpy() + len(heads)
        joined = ids.take(pa.array(which))
        _, offsets, data = joined.buffers()
        stops = np.frombuffer(offsets, np.int64)[joined.offset:][starts]
        return [np.frombuffer(data[a:b] if b > a else b"", f"<u{self.width}") for a, b in zip(stops.tolist(), stops[1:].tolist())]

    def _ids_of(self, units: list[str]) -> list[bytes]:
        """Ids of different units that follow a space."""
        found = list(map(self.units.get, units))
        missing = [u for u, ids in zip(units, found) if ids is None]
        if missing:
            new = self._learn(missing)
            found = [new[u] if ids is None else ids for u, ids in zip(units, found)]
        return found


_encoders: dict[tuple[str, str, bool, int], Encoder] = {}


def encoder(*settings) -> Encoder:
    """One per worker process, kept between tasks."""
    if settings not in _encoders:
        _encoders.clear()  # a worker keeps one table
        _encoders[settings] = Encoder(*settings)
    return _encoders[settings]


def write_records(df: DataFrame, path: str, tokenizer: str, pattern: str, end_id: int,
                  id_col: str = "doc_id", text_col: str = "text", batch: int = 1024,
                  file_bytes: int = 1 << 26, added: bool = False, cache_bytes: int = CACHE_BYTES) -> None:
    """Writes every row's token ids, ended by ``end_id``, in ascending id order.

    A null text is empty; null ids come first; rows of one id follow each other
    by the first 16 characters of their texts, then by the texts' hashes,
    repeated rows included, over as many files as they need.  Files are as many
    as keep ``file_bytes`` of text in each on average.  Other columns are not
    written.  ``df`` must be read from files, so that a task that is run again
    numbers its rows alike.  ``added`` as in ``Encoder``; a worker's table of
    units takes about ``cache_bytes``, and the more it holds the less is encoded again.
    ``tokenizer`` must be readable under that name on every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, pattern, added, cache_bytes)
        end = np.array([end_id], f"<u{coder.width}")
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.slice(at, batch)
                frames = [frame(None if null else i, np.concatenate([x, end]), coder.width) for i, null, x in zip(
                    part["id"].to_pylist(), part["no_id"].to_pylist(), coder.encode(part["text"]))]
                yield pa.RecordBatch.from_pydict({"value": pa.array(frames, pa.binary())})

    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.col(id_col).isNull().alias("no_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # An id may hold any share of the rows, so ranges go on through the text and,
    # for equal rows, a running number.  The bounds, which Spark samples on the
    # driver, are kept to a few bytes each: a short beginning, then the hash.
    order = [F.col("no_id").desc(), F.col("id"), F.substring("text", 1, 16), F.xxhash64("text"), F.col("copy")]
    total = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    tasks = max(tasks_of(rows), -(-total // file_bytes))
    numbered = rows.withColumn("copy", F.monotonically_increasing_id())
    ordered = numbered.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("copy")
    frames = ordered.mapInArrow(run, "value binary")
    frames.select(F.col("value").cast("string")).write.mode("overwrite").option("lineSep", "\n").text(path)


def record_index(spark, path: str, end_id: int | None = None) -> DataFrame:
    """The offset index, from the files themselves, all checksums verified.

    One row per record: file (number in order), path, place (in the file),
    offset, length, id, n_tokens, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers).
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, data in zip(b["path"], b["content"]):
                view, offset, rows = memoryview(data), 0, []
                while offset < len(view):
                    doc_id, ids, after = read_frame(view, offset)
                    rows.append((name, len(rows), offset, after - offset, doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    offset = after
                yield pd.DataFrame(rows, columns=["path", "place", "offset", "length", "id", "n_tokens", "ids_crc32"]).astype({"id": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    index = files.mapInPandas(run, "path string, place long, offset long, length long, id long, n_tokens long, ids_crc32 long")
    return index.withColumn("file", F.regexp_extract("path", r"part-(\d+)", 1).cast("int"))


def token_records(df: DataFrame, tokenizer: str, pattern: str, end_id: int,
                  id_col: str = "doc_id", text_col: str = "text", added: bool = False,
                  cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Writes records and index to the shared folder and reads them back.

    One row per record: id, start (ids in all records before it), n_tokens,
    ids_crc32, and where the record is.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    path, index_path = stage_path(spark, "records"), stage_path(spark, "records-index")
    write_records(df, path, tokenizer, pattern, end_id, id_col, text_col, added=added, cache_bytes=cache_bytes)
    record_index(spark, path).write.mode("overwrite").parquet(index_path)
    index = spark.read.parquet(index_path)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = (index.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
             .select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("earlier")))
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return index.join(files, "file").select(
        F.col("id").alias(id_col), (F.col("earlier") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
        "n_tokens", "ids_crc32", "path", "offset", "length")
