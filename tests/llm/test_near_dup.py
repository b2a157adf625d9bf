"""Near-duplicate groups against all pairs."""

import random
import re

import numpy as np

from stockloom.llm.near_dup import band_keys, components, fast_sketch, near_duplicates, shingle_hashes


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    comp = list(range(len(rows)))
    find = lambda i: i if comp[i] == i else find(comp[i])
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                comp[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def same(df, rows, size=3, percent=85):
    got = near_duplicates(df, shingle=size, percent=percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def altered(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"n{rng.random()}"
    return words


def test_random_groups(spark, docs):
    rng = random.Random(1)
    rows, doc_id = [], 0
    for _ in range(12):
        chain = [f"v{rng.randrange(500)}" for _ in range(rng.choice((4, 30, 120, 400)))]
        for _ in range(rng.randrange(1, 12)):  # each a step from the one before, so ends may be far apart
            rows.append((doc_id, " ".join(chain)))
            doc_id += 1
            chain = altered(rng, chain, rng.choice((0, 1, 3)))
    rng.shuffle(rows)
    same(docs(rows), rows)
    same(docs(rows), rows, size=5, percent=80)


def test_crowded_buckets(spark, docs):
    """A base text's near copies that are mostly too far from each other."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(300)]
    rows = [(i, " ".join(altered(rng, base, rng.choice((5, 8, 11))))) for i in range(60)]
    rows += [(100 + i, " ".join(base)) for i in range(40)]
    same(docs(rows), rows)


def test_common_part_with_near_copies(spark, docs):
    """A large group with a common part, in which few texts are near copies of others."""
    rng = random.Random(5)
    part = [f"p{i}" for i in range(260)]
    rows = []
    for i in range(70):
        own = [f"o{i}_{j}" for j in range(26)]
        rows.append((i, " ".join(part + own)))
        if i % 9 == 0:
            rows.append((1000 + i, " ".join(altered(rng, part + own, 3))))
    same(docs(rows), rows)
    same(docs(rows), rows, size=5, percent=80)


def test_edge_cases(spark, docs):
    rows = [(5, None), (4, ""), (3, " \t\n"), (2, "One"), (1, "one"), (8, "one two"), (9, "ONE  two"), (9, "ONE  two"),
            (None, "one two"), (7, "É é"), (6, "é É"), (10, "x y z " * 5000), (11, "x y z " * 4000), (12, None)]
    same(docs(rows, extra=True), [*rows])
    assert near_duplicates(docs([])).count() == 0


def test_sketch_is_full_and_close():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 300, 5000):
        x = rng.integers(0, 2**63, n).astype(np.uint64)
        s = fast_sketch(x, 512)
        assert len(s) == 512 and (s != np.uint64(2**64 - 1)).all()
        # Every coordinate is the least value of its bin over all rounds.
        half = fast_sketch(x[: (n + 1) // 2], 512)
        assert (s <= half).all()
    a = rng.integers(0, 2**63, 1100).astype(np.uint64)
    share = (fast_sketch(a[:1000], 512) == fast_sketch(a[100:], 512)).mean()
    assert abs(share - 900 / 1100) < 0.08
    assert len(set(band_keys(s, 64, 8).tolist())) == 64


def test_shingles_of_short_texts():
    assert len(shingle_hashes("a b", 5)) == 1 and len(shingle_hashes("", 5)) == 0
    assert (shingle_hashes("A b", 5) == shingle_hashes("a  B", 5)).all()
    assert (shingle_hashes("a b", 2) != shingle_hashes("b a", 2)).all()


def test_components_of_a_long_chain(spark):
    n = 70
    order = list(range(n))
    random.Random(3).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    assert {r.comp for r in components(links).collect()} == {0}
