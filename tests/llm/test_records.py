"""Token records: round trips, checksums, order, shuffled reads."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stockloom.llm.queries import END_ID, QUERIES, tokenizer_files
from stockloom.llm.records import Encoder, frame, masked_crc, read_frame, record_index, token_records, write_records

TEXTS = ["", "Hello world", " lead", "trail ", "two  spaces", "three   spaces here", "tab\tand\nnew\n\nlines", "a\n b", "\n", "  ", "x \n y",
         "it's we'll I'm don't", "числа 123 4567", "漢字 かな", "😀 emoji 😀😀", "<|endoftext|> is text", "nb\u00a0sp \u00a0 x", "a \u2003b", "!!! ??? ...",
         "word " * 3000, "w" * 5000, "é" * 300, "\x00\x01 odd", "s 's 't"]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_encoder_equals_the_library(tokenizer):
    rng = random.Random(4)
    parts = ["word", " ", "  ", "\n", "\t", "'s", "é", "7", "!", "漢", "\u00a0", "Ab", "\r\n"]
    texts = TEXTS + ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(3000)]
    coder = Encoder(*tokenizer_files())
    for _ in range(2):  # cold and warm
        for t, got in zip(texts, coder.encode(texts)):
            assert got.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_units_known_and_new_side_by_side(tokenizer):
    """Texts of known units, of new ones and of both, through a table that is emptied in between."""
    rng = random.Random(5)
    coder = Encoder(*tokenizer_files(), cache_bytes=2000)
    emptied = 0
    for n in range(60):
        texts = [" ".join(rng.choices(["it", "Same", "word,", "", f"n{n}x", f"w{'abc'[n % 3] * (n // 3)}.", "漢"], k=rng.randrange(6))) for _ in range(20)]
        held = len(coder.units)
        for t, ids in zip(texts, coder.encode(texts)):
            assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
        emptied += len(coder.units) < held
    assert emptied


def test_a_unit_is_looked_up_once_per_call(tokenizer):
    class Counted(dict):
        looked_up = 0

        def get(self, *key):
            self.looked_up += 1
            return super().get(*key)

    coder = Encoder(*tokenizer_files())
    texts = ["the same few words, again and again the words"] * 50 + ["and\n again the  same", ""]
    for _ in range(2):  # new and known
        coder.units = Counted(coder.units)
        for t, ids in zip(texts, coder.encode(texts)):
            assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
        assert coder.units.looked_up <= 20  # of 400 places


def test_every_byte_has_its_character(tokenizer):
    chars = [chr(c) for c in [*range(0x3000), *range(0x3000, 0x110000, 61)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{c} {c}b {c} {c}" for c in chars] + ["".join(chars[i:i + 50]) for i in range(0, len(chars), 50)]
    for t, ids in zip(texts, Encoder(*tokenizer_files()).encode(texts)):
        assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_texts_with_added_tokens_alone():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder = Encoder(*tokenizer_files(), True)
    for texts in (["<|endoftext|>", "x <|endoftext|> y"], ["", "<|endoftext|>", ""], [""], []):
        assert [x.tolist() for x in coder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_frames_detect_damage():
    data = frame(7, np.array([1, 50256]), 2) + b"\n" + frame(None, np.array([2]), 4) + b"\n"
    doc_id, ids, at = read_frame(data)
    assert (doc_id, ids.tolist()) == (7, [1, 50256])
    assert read_frame(data, at)[0] is None and read_frame(data, at)[2] == len(data)
    for i in range(at - 1):
        bad = bytearray(data)
        bad[i] ^= 4
        with pytest.raises(Exception):
            read_frame(bytes(bad))
    assert masked_crc(b"a") != zlib.crc32(b"a")


def test_round_trip(spark, docs, tokenizer):
    rows = [(i * 3 - 20, t) for i, t in enumerate(TEXTS)] + [(1000, None), (1, "again"), (1, "again"), (None, "no id"), (2**60 + 1, "large id")]
    random.Random(1).shuffle(rows)
    got = token_records(docs(rows, extra=True), *tokenizer_files(), END_ID).collect()
    assert len(got) == len(rows)
    want = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    start = 0
    for r, (i, t) in zip(sorted(got, key=lambda r: r.start), want):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [END_ID]
        assert (r.doc_id, r.start, r.n_tokens) == (i, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    for r in random.Random(2).sample(got, 10):  # any record alone, from its place in the index
        with open(r.path.removeprefix("file:"), "rb") as f:
            f.seek(r.offset)
            doc_id, ids, size = read_frame(f.read(r.length))
        assert doc_id == r.doc_id and size == r.length and zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32


def test_added_tokens_as_the_library_has_them(spark, tmp_path):
    """The query against the tokenizer as its file gives it."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> is a token", "<|endoftext|><|endoftext|>", "no token", "two  spaces <|endoftext|>", "<|endoftext", "x\n<|endoftext|>\ny"]
    spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    start = 0
    for r in sorted(QUERIES["op6_token_records"](spark, str(tmp_path)).collect(), key=lambda r: r.doc_id):
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids + [END_ID]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), texts[r.doc_id]
        start += len(ids)


def test_one_id_spans_files(spark, docs):
    texts = [f"text {i % 50:02d} of one id" for i in range(400)] + ["the very same row"] * 400
    for hot in (7, None):
        got = sorted(token_records(docs([(hot, t) for t in texts] + [(9, "other")]), *tokenizer_files(), END_ID).collect(), key=lambda r: r.start)
        files = [r.path for r in got]
        assert len(set(files)) >= 6 and max(map(files.count, files)) < 300
        assert files == sorted(files) and got[-1].doc_id == 9 and len(got) == 801
        assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))


def test_bytes_of_a_file_are_bounded(spark, docs, tmp_path):
    write_records(docs([(i, "some text " * 100) for i in range(500)]), str(tmp_path / "r"), *tokenizer_files(), END_ID, file_bytes=10_000)
    sizes = [f.stat().st_size for f in (tmp_path / "r").glob("part-*")]
    assert len(sizes) > 40 and max(sizes) < 40_000 and record_index(spark, str(tmp_path / "r")).count() == 500


def test_empty_table(spark, docs, tmp_path):
    assert token_records(docs([]), *tokenizer_files(), END_ID).count() == 0
    write_records(docs([(1, "x")]), str(tmp_path / "r"), *tokenizer_files(), END_ID)
    assert record_index(spark, str(tmp_path / "r")).count() == 1
