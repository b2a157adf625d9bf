"""Quality by co-training: two views teach each other, then score all documents.

The text view sees the text's bytes and how much it repeats itself; the metadata
view sees source, language, length and layout.  Each starts from the labelled
documents.  In every round each view scores all unlabelled texts, and the share
of them that it is surest of is given, with its label, to the other view; the
share grows from round to round.  At the end both views are calibrated on
labelled documents that neither was trained on, and their evidence is added.

Only the labelled sample (``max_labels``) is collected.  Pseudo-labels grow with the
corpus and stay where they are: a round takes them from exact histograms of the
scores, and learns from them by Newton steps whose sums Spark adds up, so what
reaches the driver is histograms and one matrix per view.  Features are one compact stage, and
texts are told apart by digest: copies of a text count once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import where_python, with_python
from stockloom.session import materialise

VIEWS = ("text_view", "meta_view")
TRIGRAMS, TEXT_STATS = 512, 4
STEPS = 16
#: A source or language is told apart if at least one in so many rows has it, so there
#: are no more of them than this.
SHARE = 256
#: Scores are counted in bins of calibrated log odds from -REACH to REACH.
REACH, BINS = 30.0, 6_000


def text_view(text: str | None) -> np.ndarray:
    """Square roots of hashed byte trigram shares, and repetition figures."""
    data = (text or "").encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    out = np.zeros(TRIGRAMS + TEXT_STATS)
    if len(raw) >= 3:
        code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
        counts = np.bincount((code * np.uint32(2654435761)) >> np.uint32(23), minlength=TRIGRAMS)
        out[:TRIGRAMS] = np.sqrt(counts / len(code))
    words = data.split()
    if words:
        n = len(words)
        out[TRIGRAMS] = sum(map(bytes.__eq__, words, words[1:])) / n
        out[TRIGRAMS + 1] = 1 - len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2) if n > 2 else 0
        out[TRIGRAMS + 2] = min(1.0, len(data) / n / 40)
        out[TRIGRAMS + 3] = np.count_nonzero((raw >= 65) & (raw <= 90)) / len(raw)
    return np.rint(255 * np.clip(out, 0, 1)).astype(np.uint8)


def _step(x: float) -> int:
    return min(STEPS - 1, int(math.log2(1 + x)))


@dataclass(frozen=True)
class Names:
    """Places of the sources and languages that are told apart."""

    sources: dict[str, int]
    langs: dict[str, int]

    @classmethod
    def of(cls, df: DataFrame, lang_col: str, source_col: str) -> Names:
        rows = df.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
        total = rows.count()

        def places(c: str) -> dict[str, int]:
            often = rows.where(F.col(c).isNotNull()).groupBy(c).count().where(F.col("count") * SHARE >= total)
            return {name: i for i, name in enumerate(sorted(r[c] for r in often.collect()))}

        return cls(places("source"), places("lang"))


def metadata_view(text: str | None, lang: str | None, source: str | None, names: Names) -> np.ndarray:
    """Indicators of source, language, length and layout; a null and any name
    that isn't told apart have an indicator each."""
    out = np.zeros(len(names.sources) + len(names.langs) + 4 + 3 * STEPS + 1, np.uint8)
    lines = (text or "").split("\n")
    n = len(text or "")
    at = 0
    for value, known in ((source, names.sources), (lang, names.langs)):
        out[at + (0 if value is None else 2 + known[value] if value in known else 1)] = 255
        at += 2 + len(known)
    for x in (n, len(lines), n / len(lines)):
        out[at + _step(x)] = 255
        at += STEPS
    out[at] = round(255 * (1 - len(set(lines)) / len(lines)))
    return out


def with_one(z: np.ndarray) -> np.ndarray:
    return np.hstack([z, np.ones((len(z), 1), z.dtype)])


def newton_sums(a: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What rows add to the Newton matrix of a logistic regression, and below it
    what they add to its gradient."""
    p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
    return np.vstack([(a * (weight * p * (1 - p))[:, None]).T @ a, (weight * (y - p)) @ a])


def newton_step(sums: np.ndarray, w: np.ndarray, ridge: float) -> np.ndarray:
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    return w + np.linalg.solve(sums[:-1] + np.diag(penalty), sums[-1] - penalty * w)


def class_weight(y: np.ndarray, bad: float, good: float) -> np.ndarray:
    """Both classes weigh half of all rows."""
    return np.where(y > 0, 0.5 / max(1.0, good), 0.5 / max(1.0, bad)) * (bad + good)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 10.0, steps: int = 12) -> np.ndarray:
    """Newton steps for a ridge logistic regression, classes weighing the same."""
    a = with_one(x)
    weight = class_weight(y, (1 - y).sum(), y.sum())
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        new = newton_step(newton_sums(a, y, weight, w), w, ridge)
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    return w


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of Platt's sigmoid, with his smoothed targets."""
    pos, neg = y.sum(), (1 - y).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        s = np.maximum(p * (1 - p), 1e-9)
        g = np.array([(margin * (t - p)).sum() - 1e-3 * a, (t - p).sum()])
        h = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-9]])
        move = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + move[0], b + move[1]
        if np.abs(move).max() < 1e-8:
            break
    return max(a, 0.0), b


@dataclass
class View:
    """A linear model on standardised features and its calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> View:
        z = x.astype(np.float32) / 255
        mean, scale = z.mean(0), 1 / np.maximum(z.std(0), 0.02)
        return cls(mean, scale, fit_logistic((z - mean) * scale, y))

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float32) / 255 - self.mean) * self.scale

    def margin(self, x: np.ndarray) -> np.ndarray:
        w = self.weights[:-1] * self.scale
        return (x.astype(np.float32) / 255) @ w + (self.weights[-1] - self.mean @ w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.margin(x) + self.offset


@dataclass
class Judge:
    """The two calibrated views, or a constant if nothing could be learned."""

    views: tuple[View, View] | None
    prior: float

    def logits(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        """Calibrated log odds of a batch's rows, by view."""
        return [view.logit(_matrix(batch.column(c))) for view, c in zip(self.views, VIEWS)]

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chances of good quality: by the text, by the metadata, by both."""
        if self.views is None:
            flat = np.full(len(text), self.prior)
            return flat, flat, flat
        a, b = self.views[0].logit(text), self.views[1].logit(meta)
        both = a + b - math.log(self.prior / (1 - self.prior))
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (a, b, both))


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1) if rows else np.zeros((0, 1), np.uint8)


def text_digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def features(df: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, names: Names | None = None) -> DataFrame:
    """(id, digest of the text, text_view, meta_view) of every row."""
    names = names or Names.of(df, lang_col, source_col)

    def make(b: pa.RecordBatch) -> dict[str, list]:
        texts, langs, sources = (b.column(c).to_pylist() for c in ("text", "lang", "source"))
        return {"text_view": [text_view(t).tobytes() for t in texts],
                "meta_view": [metadata_view(*x, names).tobytes() for x in zip(texts, langs, sources)]}

    narrow = df.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    return with_python(narrow, make, "text_view binary, meta_view binary", drop=("text", "lang", "source"))


def place(z: np.ndarray) -> np.ndarray:
    """Bins of log odds."""
    return np.clip(np.floor((np.clip(z, -REACH, REACH) + REACH) * (BINS / (2 * REACH))), 0, BINS - 1).astype(np.int32)


def surest(counts: np.ndarray, share: float, sure: float) -> tuple[int, int]:
    """From the texts per bin: the least bin of the sure good, the greatest of
    the sure bad.

    Bins are taken from the outside as long as they hold at most ``share`` of all
    texts, the first bin that holds any in each case; none where the view is less
    than ``sure``.
    """
    budget = share * counts.sum()
    least_sure = math.log(sure / (1 - sure))
    edges = np.linspace(-REACH, REACH, BINS + 1)

    def bins(n: np.ndarray, odds: np.ndarray) -> int:
        upto = np.cumsum(n)
        if not upto[-1]:
            return 0
        return int(((upto <= max(budget, n[upto > 0][0])) & (odds >= least_sure)).sum())

    return BINS - bins(counts[::-1], edges[:-1][::-1]), bins(counts, -edges[1:]) - 1


def _counts(pool: DataFrame, judge: Judge) -> np.ndarray:
    """Unlabelled texts per view and bin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BINS), np.int64)
        for b in batches:
            for v, z in enumerate(judge.logits(b)):
                counts[v] += np.bincount(place(z), minlength=BINS)
        view, at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(view, pa.int32()), pa.array(at, pa.int32()), pa.array(counts[view, at], pa.int64())], ["view", "bin", "n"])

    out = np.zeros((2, BINS), np.int64)
    for r in pool.where("good is null").mapInArrow(run, "view int, bin int, n long").groupBy("view", "bin").agg(F.sum("n").alias("n")).collect():
        out[r["view"], r["bin"]] = r["n"]
    return out


def lessons(judge: Judge, batch: pa.RecordBatch, limits: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per view: the rows of a batch that it learns from and their labels, its own
    or those that the other view is sure of."""
    known = np.array(batch.column("good").to_pylist(), float)  # NaN where unlabelled
    bins = [place(z) for z in judge.logits(batch)]
    out = []
    for v in (0, 1):
        low, high = limits[1 - v][1], limits[1 - v][0]
        told = np.where(bins[1 - v] >= high, 1.0, np.where(bins[1 - v] <= low, 0.0, np.nan))
        y = np.where(np.isnan(known), told, known)
        rows = np.flatnonzero(~np.isnan(y))
        out.append((rows, y[rows]))
    return out


def _newton(pool: DataFrame, judge: Judge, teacher: Judge, limits: list[tuple[int, int]], sizes: list[tuple[float, float]]) -> list[np.ndarray]:
    """Newton sums of both views over the labelled and the pseudo-labelled texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[np.ndarray | float] = [0.0, 0.0]
        for b in batches:
            for v, (rows, y) in enumerate(lessons(teacher, b, limits)):
                if len(rows):
                    view = judge.views[v]
                    a = with_one(view.standard(_matrix(b.column(VIEWS[v]).take(pa.array(rows))))).astype(float)
                    total[v] = total[v] + newton_sums(a, y, class_weight(y, *sizes[v]), view.weights)
        for v in (0, 1):
            if isinstance(total[v], np.ndarray):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total[v]), v), pa.int32()), pa.array(range(len(total[v])), pa.int32()),
                                                  pa.array([r.tobytes() for r in total[v]])], ["view", "line", "sums"])

    def add(batch: pa.Table) -> pa.Table:
        summed = sum(np.frombuffer(x, float) for x in batch.column("sums").to_pylist())
        return pa.table({"view": batch.column("view")[:1], "line": batch.column("line")[:1], "sums": pa.array([summed.tobytes()])})

    kind = "view int, line int, sums binary"
    lines = pool.mapInArrow(run, kind).groupBy("view", "line").applyInArrow(add, kind).collect()  # one row per line of a matrix
    out = []
    for v in (0, 1):
        found = {r["line"]: np.frombuffer(r["sums"], float) for r in lines if r["view"] == v}
        out.append(np.stack([found[i] for i in range(len(found))]) if found else np.zeros((0, 0)))
    return out


def train(stage: DataFrame, labels: DataFrame, rounds: int = 3, share: float = 0.01, sure: float = 0.97,
          max_labels: int = 8_000, steps: int = 2, ridge: float = 10.0) -> Judge:
    """Co-trains on ``stage`` (from ``features``) and labels (id, good 0/1).

    The labelled rows used are the ``max_labels`` of least hash among the labels
    of documents in the stage, a bounded sample; several labels of one id are
    averaged, half and more being good, and hold for all its texts.  A fifth of
    the labelled ids, by hash, is kept for calibration.  Pseudo-labels come from all other texts of the stage, up to ``share`` of them per view,
    class and number of the round, as far as the view is at least ``sure``.
    """
    named = (labels.where("id is not null and good is not null").groupBy("id").agg((F.avg("good") >= 0.5).cast("int").alias("good"))
             .join(stage.select("id").distinct(), "id", "left_semi")
             .withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(max_labels))
    sample = materialise(named.select("id", "good"), "cotrain-labels")
    # Labelled rows are told apart by id and text, all others by their text alone, so
    # copies of a text don't fill a round; of a row's metadata the least counts.
    known = stage.join(F.broadcast(sample), "id", "left")  # at most max_labels rows
    texts = materialise(known.withColumn("named", F.when(F.col("good").isNotNull(), F.col("id")))
                        .groupBy("named", "digest").agg(F.min(F.struct("meta_view", "text_view")).alias("x"), F.max("good").alias("good"))
                        .select("named", "digest", "x.*", "good", F.pmod(F.xxhash64("named"), F.lit(5)).alias("fold")), "cotrain-texts")
    rows = texts.where("good is not null").orderBy(F.xxhash64("named"), "named", "digest").limit(max_labels).collect()
    y = np.array([r["good"] for r in rows], float)
    fold = np.array([r["fold"] for r in rows], int)
    fit, held = fold != 0, fold == 0
    if not len(y) or min(y[fit].sum(), (1 - y[fit]).sum(), y[held].sum(), (1 - y[held]).sum()) < 1:
        return Judge(None, float(y.mean()) if len(y) else 1.0)
    x = [np.stack([np.frombuffer(r[c], np.uint8) for r in rows]) for c in VIEWS]
    prior = float(y.mean())

    def calibrated(views: list[View]) -> Judge:
        for v, view in enumerate(views):
            view.slope, view.offset = calibrate(view.margin(x[v][held]), y[held])
        return Judge((views[0], views[1]), prior)

    judge = calibrated([View.fit(x[v][fit], y[fit]) for v in (0, 1)])
    learnt = texts.where("good is null or fold <> 0")
    for number in range(1, rounds + 1):
        counts = _counts(texts, judge)
        limits = [surest(n, share * number, sure) for n in counts]
        sizes = []
        for v in (0, 1):
            high, low = limits[1 - v]
            told = counts[1 - v]
            sizes.append(((1 - y[fit]).sum() + told[:low + 1].sum(), y[fit].sum() + told[high:].sum()))
        teacher, views = judge, [*judge.views]
        for _ in range(steps):
            sums = _newton(learnt, Judge((views[0], views[1]), prior), teacher, limits, sizes)
            views = [replace(view, weights=newton_step(s, view.weights, ridge)) for view, s in zip(views, sums)]
        judge = calibrated(views)
    return judge


def quality_scores(df: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang", source_col: str = "source", label_id: str = "doc_id", label: str = "quality", **training) -> DataFrame:
    """One row per row of ``df``: id, text_score, meta_score, score, kept.

    Nulls are values of their own; an empty text has empty features.  Without
    labels of both classes there is nothing to learn: all scores are the share
    of good labels, or 1 without any.  Labels of one document are averaged.
    Other columns are ignored.
    """
    stage = materialise(features(df, id_col, text_col, lang_col, source_col), "cotrain-features")
    judge = train(stage, labels.select(F.col(label_id).alias("id"), F.col(label).alias("good")), **training)

    def score(b: pa.RecordBatch) -> dict[str, list]:
        a, m, both = judge.scores(_matrix(b.column("text_view")), _matrix(b.column("meta_view")))
        return {"text_score": a, "meta_score": m, "score": both, "kept": both >= threshold}

    return with_python(stage, score, "text_score double, meta_score double, score double, kept boolean",
                       drop=("digest", "text_view", "meta_view")).withColumnRenamed("id", id_col)


def drop_bad(df: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", source_col: str = "source", label_id: str = "doc_id", label: str = "quality", **training) -> DataFrame:
    """The rows of ``df`` that ``quality_scores`` keeps; all columns as they are."""
    names = Names.of(df, lang_col, source_col)
    stage = materialise(features(df, id_col, text_col, lang_col, source_col, names), "cotrain-features")
    judge = train(stage, labels.select(F.col(label_id).alias("id"), F.col(label).alias("good")), **training)

    def keep(b: pa.RecordBatch) -> list[bool]:
        texts, langs, sources = (b.column(c).to_pylist() for c in (text_col, lang_col, source_col))
        if not texts:
            return []
        a = np.stack([text_view(t) for t in texts])
        m = np.stack([metadata_view(*x, names) for x in zip(texts, langs, sources)])
        return (judge.scores(a, m)[2] >= threshold).tolist()

    return where_python(df, keep)
