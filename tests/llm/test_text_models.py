"""Language and quality: held-out accuracy, and what is defined without data."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from stockloom.llm import cotraining, lang_zstd
from stockloom.llm.queries import QUERIES, held_out

FOLDER = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    got = QUERIES["op8_zstd_language"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang", "n_chars")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == truth.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r.lang_pred == r.lang for r in rows if r.held_out and r.n_chars >= 200]
    assert len(held) > 100 and np.mean(held) >= 0.97


def test_language_cases(spark, docs):
    learned = {"aa": b"ababab abab ababa " * 50, "zz": b"yzyzyz zyzy yzyz " * 50}
    rows = [(1, "abab ababab abab"), (2, "zyzyzy ZYZY yzyz"), (3, None), (4, ""), (5, "123 !!"), (6, "ab" * 200_000), (None, "abab abab")]
    got = {r.doc_id: r for r in lang_zstd.predict_language(docs(rows, extra=True), learned).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5, 6, None)] == ["aa", "zz", "und", "und", "und", "aa", "aa"]
    assert all(got[i].rejected and got[i].score == 0 for i in (3, 4, 5))
    assert [r.lang_pred for r in lang_zstd.predict_language(docs([(1, "abc")]), {}).collect()] == ["und"]
    assert [r.score for r in lang_zstd.predict_language(docs([(1, "abc")]), {"aa": b"abc"}).collect()] == [1.0]
    tie = lang_zstd.predict_language(docs([(1, "qqqq")]), {"b": b"x" * 40, "a": b"x" * 40}).first()
    assert (tie.lang_pred, tie.rejected) == ("a", True)
    assert lang_zstd.predict_language(docs([]), learned).count() == 0


def test_dictionaries_are_bounded_and_labelled(spark, docs):
    rows = [(i, f"text {i} " * 20, ("en", "de", None)[i % 3], "s") for i in range(300)] + [(999, None, "fr", "s")]
    found = lang_zstd.learn_dictionaries(docs(rows), "text", "lang", dict_bytes=2_000, key_col="doc_id")
    assert sorted(found) == ["de", "en"] and all(1_500 < len(p) < 2_500 for p in found.values())
    assert found == lang_zstd.learn_dictionaries(docs(rows[::-1]).repartition(5), "text", "lang", dict_bytes=2_000, key_col="doc_id")
    assert lang_zstd.learn_dictionaries(docs([]), "text", "lang") == {}
    assert spark.range(1).select(held_out("id")).first()[0] == (zlib.crc32(b"0") % 5 == 0)


def test_languages_of_long_texts_only_are_learned(spark, docs):
    book = " ".join(f"libro{i % 977} pagina{i}" for i in range(60_000))
    rows = [(1, "short text", "en", "s"), (2, book, "it", "s"), (None, "w" * 5_000, "ja", "s")] + [(3, "same " * 1_000, "fr", "s")] * 50
    found = lang_zstd.learn_dictionaries(docs(rows), "text", "lang", key_col="doc_id")
    assert sorted(found) == ["en", "fr", "it", "ja"] and 200_000 <= len(found["it"]) < 203_000
    third = len(book) // 3
    assert all(any(line in part for line in found["it"].decode().split("\n") if line) for part in (book[:third], book[third:2 * third], book[2 * third:]))
    tiny = lang_zstd.learn_dictionaries(docs(rows), "text", "lang", dict_bytes=1, key_col="doc_id")
    assert sorted(tiny) == ["en", "fr", "it", "ja"]


def test_quality_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("test")), F.lit(3)) == 0
    got = cotraining.quality_scores(docs, labels.where(~fold))
    rows = got.join(labels.where(fold), "doc_id").collect()
    assert got.count() == docs.count()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert len(bad) >= 10 and np.mean(good) >= 0.98 and np.mean(bad) <= 0.15


def test_views_teach_each_other(spark, docs):
    """Half of the sources are only ever good or bad, and few texts are labelled."""
    rows = [(i, ("fine words here " if i % 2 else "$$$ ### %%% ") * (5 + i % 7), "en", f"s{i % 2}") for i in range(400)]
    stage = cotraining.features(docs(rows), "doc_id", "text", "lang", "source")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "id long, good int")
    alone, taught = cotraining.train(stage, labels, rounds=0), cotraining.train(stage, labels, rounds=3, sure=0.8)
    assert not np.array_equal(alone.views[1].weights, taught.views[1].weights)
    again = cotraining.train(stage.repartition(5), labels, rounds=3, sure=0.8)
    assert np.allclose(taught.views[0].weights, again.views[0].weights)


def plain_judge(spark, rows, labels, rounds, share, sure, steps=2):
    """Co-training of (id, text, lang, source) in one process, with whole arrays."""
    from collections import Counter

    total, names = len(rows), []
    for c in (3, 2):
        often = [v for v, n in Counter(r[c] for r in rows if r[c] is not None).items() if n * cotraining.SHARE >= total]
        names.append({v: i for i, v in enumerate(sorted(often))})
    known = {}
    for i, good in labels:
        if i is not None and good is not None:
            known.setdefault(i, []).append(good)
    known = {i: int(np.mean(g) >= 0.5) for i, g in known.items()}
    texts = {}
    for i, text, lang, source in rows:
        view = (cotraining.metadata_view(text, lang, source, cotraining.Names(*names)).tobytes(), cotraining.text_view(text).tobytes())
        at = (i if i in known else None, text or "")
        texts[at] = min(texts.get(at, view), view)
    keys = sorted(texts, key=repr)
    hashed = spark.createDataFrame([(i,) for i in known], "i long").select("i", F.pmod(F.xxhash64("i"), F.lit(5)).alias("f"))
    fold = {r.i: r.f for r in hashed.collect()}
    x = [np.stack([np.frombuffer(texts[k][1 - v], np.uint8) for k in keys]) for v in (0, 1)]
    y = np.array([np.nan if i is None else float(known[i]) for i, _ in keys])
    fit = ~np.isnan(y) & np.array([i is not None and fold[i] != 0 for i, _ in keys])
    held, free = ~np.isnan(y) & ~fit, np.isnan(y)
    views = [cotraining.View.fit(x[v][fit], y[fit]) for v in (0, 1)]

    def calibrate():
        for v in (0, 1):
            views[v].slope, views[v].offset = cotraining.calibrate(views[v].margin(x[v][held]), y[held])

    calibrate()
    for number in range(1, rounds + 1):
        told = []
        for v in (0, 1):
            z = views[v].logit(x[v])
            bins = np.clip(np.floor((np.clip(z, -30, 30) + 30) * 100), 0, 5999)
            label = np.full(len(z), np.nan)
            for sign, value in ((-1, 1.0), (1, 0.0)):  # from the surest bin on
                taken = 0
                for b in sorted(set(bins[free].tolist()), key=lambda b: sign * b):
                    n = int((bins[free] == b).sum())
                    edge = -30 + b / 100 if value else -(-30 + (b + 1) / 100)
                    if edge < np.log(sure / (1 - sure)) - 1e-9 or (taken and taken + n > share * number * free.sum()):
                        break
                    label[bins == b] = value
                    taken += n
                    if taken > share * number * free.sum():
                        break
            told.append(label)
        for v in (0, 1):
            target = np.where(fit, y, np.where(free, told[1 - v], np.nan))
            use = ~np.isnan(target)
            a, t = cotraining.with_one(views[v].standard(x[v][use])).astype(float), target[use]
            weight = np.where(t > 0, 0.5 / max(1, t.sum()), 0.5 / max(1, (1 - t).sum())) * len(t)
            w = views[v].weights
            for _ in range(steps):
                p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
                penalty = np.array([10.0] * (len(w) - 1) + [1e-6])
                w = w + np.linalg.solve(a.T @ (a * (weight * p * (1 - p))[:, None]) + np.diag(penalty), a.T @ (weight * (t - p)) - penalty * w)
            views[v] = cotraining.View(views[v].mean, views[v].scale, w)
        calibrate()
    judge = cotraining.Judge((views[0], views[1]), float(y[~free].mean()))
    own = [np.stack([f for f in fs]) for fs in zip(*[(cotraining.text_view(t), cotraining.metadata_view(t, lang, source, cotraining.Names(*names))) for _, t, lang, source in rows])]
    return [(r[0], *(float(p) for p in scores)) for r, scores in zip(rows, zip(*judge.scores(*own)))]


def test_quality_against_plain(spark, docs):
    """With copies, null ids and texts, one id with two texts, contradicting labels and rare sources."""
    import random

    rng = random.Random(21)
    words = {True: ["fine", "plain", "words", "story", "river"], False: ["$$$", "buy", "###", "click", "now"]}
    rows = []
    for i in range(700):
        good = rng.random() < 0.6
        body = " ".join(rng.choice(words[good if rng.random() < 0.85 else not good]) for _ in range(rng.randrange(3, 60)))
        rows.append((i, body, rng.choice(["en", None, "de"]), rng.choice(["web", "news", f"rare{i}"]) if good else rng.choice(["spam", "web", None])))
    rows += [rows[3]] * 40 + [(None, rows[4][1], "en", "web"), (None, None, None, None), (5, "another text of one id", "en", "news"), (701, "", "en", "web")]
    labels = [(i, int("$" not in rows[i][1][:20])) for i in range(0, 300)] + [(7, 0), (7, 1), (None, 1), (9_999, 1), (8, None)]
    told = spark.createDataFrame(labels, "doc_id long, quality int")
    df = docs(rows, extra=True)
    for rounds in (0, 3):
        want = sorted(plain_judge(spark, rows, labels, rounds, 0.05, 0.8), key=repr)
        for table in (df, df.repartition(7)):
            got = sorted(((r.doc_id, r.text_score, r.meta_score, r.score) for r in cotraining.quality_scores(table, told, rounds=rounds, share=0.05, sure=0.8).collect()), key=repr)
            assert [g[0] for g in got] == [w[0] for w in want]
            key = lambda r: (str(r[0]), *(round(v, 5) for v in r[1:]))
            assert np.allclose([g[1:] for g in sorted(got, key=key)], [w[1:] for w in sorted(want, key=key)], atol=1e-6)


def test_pseudo_labels_follow_the_corpus():
    counts = np.zeros(cotraining.BINS, np.int64)
    counts[-900:] = 10
    counts[:900] = 10
    for scale in (1, 1000):
        high, low = cotraining.surest(counts * scale, 0.01, 0.97)
        assert cotraining.BINS - high == low + 1 == 18  # 1 % of 1,800 full bins, however full
    counts[-1] = 10 ** 9
    assert cotraining.surest(counts, 0.0001, 0.97)[0] == cotraining.BINS - 1
    assert cotraining.surest(counts * 0, 0.01, 0.97) == (cotraining.BINS, -1)


def test_labels_of_other_documents_use_up_nothing(spark, docs):
    rows = [(i, ("fine words here " if i % 2 else "$$$ ### %%% ") * (5 + i % 7), "en", f"s{i % 3}") for i in range(100)]
    stage = cotraining.features(docs(rows), "doc_id", "text", "lang", "source")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(i, 1) for i in range(1_000, 9_000)], "id long, good int")
    assert cotraining.train(stage, labels, rounds=0, max_labels=60).views is not None


def test_quality_without_labels(spark, docs):
    rows = [(1, "a b c"), (2, None), (3, ""), (None, "x" * 300_000), (1, "a b c", None, None)]
    df = docs(rows, extra=True)
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = cotraining.quality_scores(df, none).collect()
    assert len(got) == 5 and all(r.kept and r.score == 1 for r in got)
    assert cotraining.drop_bad(df, none).columns == df.columns
    one = spark.createDataFrame([(1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    assert [r.score for r in cotraining.quality_scores(df, one).collect()] == [0.0] * 5
    assert cotraining.quality_scores(docs([]), none).count() == 0 and cotraining.drop_bad(docs([]), one).count() == 0
