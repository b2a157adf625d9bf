"""Order MinHash against a plain version of its definition."""

import hashlib
import re
import struct

import xxhash

from stockloom.llm.order_minhash import edited_fingerprints, with_order_minhash

UNIT = re.compile("[⺀-鿿가-힯豈-﫿]|[^ \t\n\x0b\f\r⺀-鿿가-힯豈-﫿]{1,16}")


def hash_long(value, seed):
    value &= (1 << 64) - 1
    return xxhash.xxh64_intdigest(struct.pack("<Q", value), seed)


def plain(text, k=3, l=2, m_bits=5):  # noqa: E741
    words = [xxhash.xxh64_intdigest(x.encode(), 42) for x in UNIT.findall(text or "")]
    mers = list(words)
    for i in range(2, k + 1):
        mers = [hash_long(words[j + i - 1], hash_long(a, 42)) if j + i - 1 < len(words) else hash_long(a, 42)
                for j, a in enumerate(mers)]
    if not mers:
        return []
    seen, numbered = {}, []
    for place, h in enumerate(mers):
        low = h & 0xFFFFFFFF
        n = seen.get(low, 0)
        seen[low] = n + 1
        hashed = xxhash.xxh64_intdigest(struct.pack("<i", n), hash_long(low, 42)) & 0xFFFFFFFF
        numbered.append((hashed, place))
    out = []
    for j in range(1 << m_bits):
        mask = j << (32 - m_bits)
        least = sorted(numbered, key=lambda x: (x[0] ^ mask, x[1]))[:l]
        h = 42
        for place in sorted(p for _, p in least):
            h = hash_long(mers[place], hash_long(h, 42))
        out.append("%08x" % (h & 0xFFFFFFFF))
    return out


def likeness(a, b):
    return float(a == b) if not a or not b else sum(x == y for x, y in zip(a, b)) / len(a)


def check(df, rows):
    ordered = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0,
                     hashlib.md5(f"{'' if r[0] is None else r[0]}|{r[1]}".encode()).hexdigest()))
    got = {}
    for r in edited_fingerprints(df).collect():
        got.setdefault((r.doc_id, r.n_chars), []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for at, (i, text) in enumerate(ordered):
        after = ordered[(at + 1) % len(ordered)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        a, b, c = plain(text), plain(edited), plain(after)
        want = (hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), likeness(a, b), likeness(a, c))
        found = [tuple(r)[2:] for r in got[i, len(text)]]
        assert want in found


def test_against_definition(spark, docs):
    rows = [(3, "one two three four five six seven eight " * 9), (1, "a b c"), (2, ""), (7, None), (5, "x"),
            (8, "Orre " * 60), (9, "žluťoučký kůň 漢字漢字漢字 " * 20), (10, "a b c"), (11, "w" * 400), (12, " \n\t "),
            (None, "no id here at all"), (4, " ".join(f"w{i}" for i in range(3000))), (1, "a b c")]
    check(docs(rows, extra=True), rows)


def test_one_document_and_none(spark, docs):
    check(docs([(1, "just one text of some words")]), [(1, "just one text of some words")])
    assert edited_fingerprints(docs([])).count() == 0


def test_order_matters(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[200:] + words[:200]), " ".join(words[:390] + ["z"] * 10)]
    df = with_order_minhash(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "text", "f")
    a, moved, near = [r.f for r in df.orderBy("i").collect()]
    share = lambda x, y: sum(p == q for p, q in zip(x, y)) / len(x)
    assert share(a, near) > 0.8 > share(a, moved)  # the same words in another order are less alike


def test_native_plan(spark, docs):
    plan = with_order_minhash(docs([(1, "a b c d")]), "text", "f")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
