"""Quality classification by co-training.

Two views of a document: its text (the words it uses, by their log odds among good and bad
labelled texts, and shares that tell running text from junk) and its metadata (language,
source, declared size).  A logistic classifier on each starts from labelled rows; over
rounds each gives the other its most confident pseudo-labels, picked from all unlabelled
documents.  The two views are then calibrated and combined on labelled rows held back from
training, and every document is scored.

The views of all documents are staged once, some numbers a row.  A round is a histogram of
the teachers' scores, which gives the score that the most confident share lies beyond, and
STEPS sums for Newton's method; both are taken in Spark, and what comes to the driver has
the size of the model.  Of the labelled rows, at most LABELLED take part as such, in the
order of a hash of doc_id, a documented parameter; the others count as unlabelled.

Defined results: null and empty texts are scored as empty texts; null metadata is a
value of its own; null labels do not train; without labelled rows of both kinds every
document gets the share of good labels (1 if there are none); rows that repeat a
doc_id, or have none, are scored row by row, and train as one row with the label; an
empty table gives no rows; further columns are carried along, but for quality_score,
which is made anew.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage, tidy, unstage

LABELLED, ROUNDS, STEPS, KEEP = 12_000, 4, 2, 0.2
#: A document goes only if the views are four to one against it.  Of the unlabelled rows, the share whose pseudo-labels each round adds, and how sure a teacher must be of them.
SHARE, SURE = 0.05, 0.95
BUCKETS, WORDS, BINS = 32, 1 << 16, 2400
TEXT = ("symbols", "capitals", "digits", "repeats", "distinct", "marks", "bars", "word_length", "line_words", "ends", "words", "empty", "odds", "odd_words")


def text_view(text: str | None, odds: np.ndarray) -> list[float]:
    """Shares and averages of the whole text that do not grow with its length; odds: of each word bucket."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * (len(TEXT) - 3) + [1.0, 0.0, 0.0]
    n, size = len(words), sum(map(len, words))
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(1, int(kinds[65:91].sum() + kinds[97:123].sum()))
    low = [w.lower() for w in words]
    tally = Counter(low)
    own = odds[np.fromiter(map(zlib.crc32, tally), np.int64, len(tally)) % WORDS]
    often = np.fromiter(tally.values(), np.float64, len(tally))
    lines = raw.count(b"\n") + 1
    odd = sum(int(kinds[c]) for c in b"#$%&*@^~{}[]<>\\=_")
    same = sum(map(eq, low, low[1:]))
    return [
        min(1.0, odd / size * 4),
        int(kinds[65:91].sum()) / letters,
        int(kinds[48:58].sum()) / size,
        same / n,
        len(tally) / n ** 0.8,
        min(1.0, int(kinds[33] + kinds[63]) / n),
        min(1.0, int(kinds[124]) / n),
        min(2.0, size / n / 8),
        min(2.0, n / lines / 100),
        min(1.0, int(kinds[46]) / n * 4),
        math.log1p(n) / 10,
        0.0,
        float(own @ often) / n,
        float(own.mean()),
    ]


def _bucket(name: str, value) -> int:
    return zlib.crc32(f"{name}={value}".encode()) % BUCKETS


META = 2 * BUCKETS + 21
STAGED = ["doc_id", "lang", "source", "n_chars", "quality", "order", "text_view"]


def meta_view(lang: list, source: list, n_chars: list) -> np.ndarray:
    """A row for each document: language and source hashed to buckets, and the declared size in steps of two."""
    out = np.zeros((len(lang), META))
    rows = np.arange(len(lang))
    for first, name, values in ((0, "lang", lang), (BUCKETS, "source", source)):
        at = {v: first + _bucket(name, v) for v in set(values)}
        out[rows, np.fromiter((at[v] for v in values), np.int64, len(values))] = 1.0
    size = np.fromiter((max(0, n or 0) for n in n_chars), np.float64, len(n_chars))
    step = np.where(size < 1, 0, np.minimum(19, np.floor(np.log2(np.maximum(size, 1))) + 1)).astype(np.int64)
    out[rows, 2 * BUCKETS + step] = 1.0
    out[:, -1] = np.log1p(size) / 10
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3) -> np.ndarray:
    """Newton's method with a ridge; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight
    w, keep = np.zeros(x.shape[1]), ridge * weight.sum() * np.ones(x.shape[1])
    keep[-1] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + keep * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(keep + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


class Model:
    """Weights of the two views and of their combination; none of them if labels are of one kind."""

    def __init__(self, share, text=None, meta=None, both=None):
        self.share, self.text, self.meta, self.both = share, text, meta, both
        self.odds = np.zeros(WORDS)

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        if self.text is None:
            return np.full(len(text), self.share)
        return 1 / (1 + np.exp(-logit(np.column_stack([logit(text, self.text), logit(meta, self.meta)]), self.both)))


def co_train(views: list[np.ndarray], y: np.ndarray, pool: Pool) -> Model:
    """views: the text view and the metadata view of the labelled rows, in hash order."""
    share = float(y.mean()) if len(y) else 1.0
    if len(np.unique(y)) < 2:
        return Model(share)
    back = np.arange(len(y)) % 4 == 3  # held back for calibration
    if len(np.unique(y[back])) < 2 or len(np.unique(y[~back])) < 2:
        back = np.zeros(len(y), bool)
    weights = [logistic(v[~back], y[~back]) for v in views]
    for r in range(1, ROUNDS + 1):
        cuts = [cutoffs(h, r * SHARE * pool.size, share) for h in pool.histograms(weights)]
        if not pool.size or not np.isfinite(cuts).any():
            break
        teachers = [w.copy() for w in weights]
        for _ in range(STEPS):
            sums = pool.sums(teachers, cuts, weights)
            weights = [_step(v[~back], y[~back], w, *s) for v, w, s in zip(views, weights, sums)]
    fit = back if back.any() else np.ones(len(y), bool)
    both = logistic(np.column_stack([logit(v[fit], w) for v, w in zip(views, weights)]), y[fit], ridge=1e-6)
    return Model(share, weights[0], weights[1], both)


def _step(x: np.ndarray, y: np.ndarray, w: np.ndarray, grad: np.ndarray, hess: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """One of Newton's steps over labelled rows and the sums over pseudo-labelled ones."""
    x = np.column_stack([x, np.ones(len(x))])
    g, h = newton_sums(x, y, w)
    keep = ridge * len(x) * np.ones(len(w))
    keep[-1] = 1e-9
    step = np.linalg.solve(h + hess + np.diag(keep + 1e-9), g + grad + keep * w)
    return np.round(w - np.clip(step, -5, 5), 9)  # sums in another order give the same weights


def newton_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the loss; x with its column of ones."""
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return x.T @ (p - y), (x * (p * (1 - p))[:, None]).T @ x


def cutoffs(histogram: np.ndarray, most: float, share: float) -> tuple[float, float]:
    """(low, high): beyond these scores lie the surest bad and good rows, as many of each kind as
    labels suggest, a bin more at most."""
    least = math.log(SURE / (1 - SURE))
    edges = np.linspace(-30, 30, BINS + 1)
    down = np.cumsum(histogram[::-1])[::-1]  # rows from each bin on
    up = np.cumsum(histogram)
    high = next((edges[i] for i in range(BINS) if down[i] <= max(1.0, most * share)), np.inf)
    low = next((edges[i + 1] for i in range(BINS - 1, -1, -1) if up[i] <= max(1.0, most * (1 - share))), -np.inf)
    return (min(low, -least) if up.any() else -np.inf), (max(high, least) if down.any() else np.inf)


class Pool:
    """The views of all unlabelled rows, in Spark."""

    def __init__(self, views: DataFrame):
        self.views, self.size = views, views.count()

    def _summed(self, run) -> np.ndarray:
        """Sums of the arrays that run gives for the batches, added up in Spark."""

        def each(batches):
            total = None
            for b in slices(batches, 5000):
                part = run(_matrices(b))
                total = part if total is None else total + part
            if total is not None:
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.float64())], ["at", "value"])

        rows = self.views.mapInArrow(tidy(each), "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(2 * BINS + sum(_sizes()))
        for r in rows:  # as many as the model has sums
            out[r["at"]] = r["value"]
        return out

    def histograms(self, weights: list[np.ndarray]) -> list[np.ndarray]:
        def run(views):
            found = [np.histogram(logit(v, w), BINS, (-30, 30))[0].astype(float) for v, w in zip(views, weights)]
            return np.concatenate(found)

        total = self._summed(run)
        return [total[:BINS], total[BINS : 2 * BINS]]

    def sums(self, teachers: list[np.ndarray], cuts: list[tuple[float, float]], weights: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(gradient, Hessian) for each view over the rows that the other view is sure of, at half weight."""

        def run(views):
            out = []
            for own, other in ((0, 1), (1, 0)):
                said = logit(views[other], teachers[other])
                low, high = cuts[other]
                sure = (said >= high) | (said <= low)
                x = np.column_stack([views[own][sure], np.ones(int(sure.sum()))])
                g, h = newton_sums(x, (said[sure] >= high).astype(float), weights[own])
                out += [0.5 * g, 0.5 * h.ravel()]
            return np.concatenate(out)

        total, at, out = self._summed(run), 0, []
        for n in (len(TEXT) + 1, META + 1):
            out.append((total[at : at + n], total[at + n : at + n + n * n].reshape(n, n)))
            at += n + n * n
        return out


def _sizes() -> list[int]:
    return [n + n * n for n in (len(TEXT) + 1, META + 1)]


def _matrices(b: pa.RecordBatch) -> list[np.ndarray]:
    """Text and metadata views of a batch of staged rows."""
    text = np.asarray(b.column("text_view").flatten(), np.float64).reshape(-1, len(TEXT))
    return [text, meta_view(*(b.column(c).to_pylist() for c in ("lang", "source", "n_chars")))]


def _views(texts, langs, sources, sizes, odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    text = np.array([text_view(t, odds) for t in texts], float).reshape(-1, len(TEXT))
    return text, meta_view(langs, sources, sizes)


def word_odds(told: DataFrame) -> np.ndarray:
    """Log odds of each word bucket in good against bad texts; told: text, quality."""

    def run(batches):
        for b in slices(batches):
            held = np.zeros((WORDS, 2))
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = set((text or "").encode().lower().split())
                held[np.unique(np.fromiter(map(zlib.crc32, own), np.int64, len(own)) % WORDS), int(label)] += 1
            at = np.flatnonzero(held.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at, 0], pa.float64()), pa.array(held[at, 1], pa.float64())], ["at", "bad", "good"])

    rows = told.select("text", "quality").mapInArrow(tidy(run), "at long, bad double, good double").groupBy("at").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()
    held = np.zeros((WORDS, 2))
    for r in rows:  # at most WORDS
        held[r["at"]] = r["bad"], r["good"]
    texts = np.maximum(held.max(axis=0), 1.0)
    return np.log((held[:, 1] + 0.5) / (texts[1] + 1)) - np.log((held[:, 0] + 0.5) / (texts[0] + 1))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    order = F.xxhash64(F.col("doc_id").cast("string"))
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.max("quality") > 0).cast("int").alias("quality"))
    picked = F.broadcast(stage(known.withColumn("order", order).orderBy("order", "doc_id").limit(LABELLED), "labelled"))  # LABELLED rows at most
    told = docs.select("doc_id", "text").join(picked, "doc_id")
    # a labelled row's words have the odds that the other half of the rows gives: the weights would else trust them too much
    told = told.dropDuplicates(["doc_id"])
    halves = [word_odds(told.filter(F.pmod("order", F.lit(2)) == i)) for i in (1, 0)]
    odds = (halves[0] + halves[1]) / 2

    def run(batches):
        for b in slices(batches):
            text = [text_view(t, odds if o is None else halves[o % 2]) for t, o in zip(b.column("text").to_pylist(), b.column("order").to_pylist())]
            text = np.array(text, float).reshape(-1, len(TEXT))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in STAGED[:-1]), pa.array(text.tolist(), pa.list_(pa.float64()))], STAGED)

    some = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars")).join(picked, "doc_id", "left")
    kinds = {"doc_id": docs.schema["doc_id"].dataType.simpleString(), "lang": "string", "source": "string", "n_chars": "long", "quality": "int", "order": "long", "text_view": "array<double>"}
    views = stage(some.select("text", *STAGED[:-1]).mapInArrow(tidy(run), ", ".join(f"{c} {kinds[c]}" for c in STAGED)), "views")
    rows = views.filter("quality is not null").groupBy("doc_id").agg(F.min(F.struct("order", "quality", "lang", "source", "n_chars", "text_view")).alias("x")).select("x.*").collect()
    rows = sorted(rows, key=lambda r: r["order"])
    text = np.array([r["text_view"] for r in rows], float).reshape(-1, len(TEXT))
    meta = meta_view(*([r[c] for r in rows] for c in ("lang", "source", "n_chars")))
    model = co_train([text, meta], np.array([float(r["quality"]) for r in rows]), Pool(views.filter("quality is null")))
    model.odds = odds
    unstage(views)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with `quality_score`, the probability that a document is good."""
    names = [c for c in docs.columns if c != "quality_score"]
    size = "__size"
    while size in names:
        size += "_"

    def run(batches):
        for b in slices(batches):
            text, meta = _views(*(b.column(c).to_pylist() for c in ("text", "lang", "source", size)), model.odds)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(model.score(text, meta), pa.float64())], [*names, "quality_score"])

    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in names) + "quality_score double"
    return docs.select(*names, F.col("n_chars").cast("long").alias(size)).mapInArrow(tidy(run), schema)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = KEEP) -> DataFrame:
    """The documents whose score is `least` or more, with their own columns."""
    return score(docs, fit(docs, labels)).filter(F.col("quality_score") >= least).select(*docs.columns)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", "text", "lang", "source", "n_chars"), fit(docs, labels))
    return scored.select("doc_id", "quality_score", (F.col("quality_score") >= KEEP).cast("int").alias("predicted"))
