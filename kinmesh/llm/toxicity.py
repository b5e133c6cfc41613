"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, homoglyphs, invisible characters, digit and symbol
substitutions inside words), cut into words, and matched by an Aho-Corasick automaton over learned terms: whole
words and word beginnings, the latter for words that take many endings.  A hit
inside an exception phrase does not count.  The weights of the hits, in sum and by
length, go through a logistic curve to a score from 0 to 1.

Terms, weights, exception phrases and the curve come from labelled training rows
only.  Statistics of words cover all of them and words of any length; a word of over
LONG_WORD characters counts by its beginnings, of which the longest has MAX_PREFIX.
The size of the lexicon is a parameter of the model: MAX_TERMS terms and MAX_PHRASES
phrases, the strongest first, far above what passes the tests of significance.  The
curve is fitted on at most FIT_ROWS rows of each label, taken in the order of a hash.
Scores use the text alone.

Defined results: null and empty texts score as texts without a hit; null labels do
not train; without labelled rows of both kinds every document gets the share of
toxic labels (0 if there are none); rows that repeat a doc_id are scored row by row;
rows without a doc_id are scored and not held out; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, small, stage, tidy

MAX_TERMS, MAX_PHRASES, FIT_ROWS = 200_000, 50_000, 20_000
MIN_PREFIX, MAX_PREFIX, LONG_WORD, MIN_ODDS = 4, 24, 64, 2.5
#: A term's counts must be this unlikely under the labels' shares (G statistic), and
#: the words before it this varied: what one copied passage repeats is no abuse.
MIN_SURPRISE, MIN_NEIGHBOURS = 20.0, 3
#: Letters that look like Latin ones.
HOMOGLYPHS = str.maketrans("аеорсухіјѕԁһкмтвнгп" + "αβεικνορτυχη", "aeopcyxijsdhkmtbhrn" + "abeiknoptuxn")
#: Digits and symbols written for letters.
SUBSTITUTES = str.maketrans("0134578@$", "oieastbas")
#: Marks over letters, soft hyphens, zero-width and direction characters, variation selectors.
UNSEEN = re.compile("[\u0300-\u036f\u00ad\u034f\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufe00-\ufe0f\ufeff]+")
LOOKALIKE = re.compile("[\u0370-\u03ff\u0400-\u052f]")
SYMBOL = re.compile("[0-9@$]")
SUBSTITUTED = re.compile(r"(?<![^\W_@$])[^\W\d_]*+[0-9@$](?:[^\W_]|[@$])*+")
#: Everything ASCII but letters and digits parts words, and so does punctuation beyond it.
APART = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
PUNCTUATION = re.compile("[\u00a0-\u00a9\u00ab-\u00b4\u00b6-\u00b9\u00bb-\u00bf\u2000-\u206f\u2190-\u2bff\u3000-\u303f]")


def _unmask(m: re.Match) -> str:
    word = m.group()
    core = word.rstrip("@$")
    return core.translate(SUBSTITUTES) + " " if re.search(r"[^\W\d_]", core) else " "


def fold(text: str | None) -> str:
    """Words of the folded text between single spaces, one space at either end."""
    if not text:
        return " "
    if not text.isascii():  # compatibility forms, marks apart from their letters, then without them
        text = UNSEEN.sub("", unicodedata.normalize("NFKD", text))
    text = text.lower()
    if not text.isascii():
        if LOOKALIKE.search(text):
            text = text.translate(HOMOGLYPHS)
        text = PUNCTUATION.sub(" ", text)
    if SYMBOL.search(text):
        text = SUBSTITUTED.sub(_unmask, text)
    return " " + b" ".join(text.encode().translate(APART).split()).decode() + " "


def _stem(word: str) -> str:
    """The word, or of a long one as much as its longest beginning needs; a star tells that there is more."""
    return word if len(word) <= LONG_WORD else word[:MAX_PREFIX] + "*"


def _incidence(batches):
    """(word, toxic, clean): in how many texts of the batch a word is, by label."""
    for b in batches:
        tally: dict[str, list[int]] = {}
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for w in {_stem(w) for w in text.split()}:
                tally.setdefault(w, [0, 0])[0 if toxic else 1] += 1
        words = list(tally)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([tally[w][0] for w in words], pa.int64()), pa.array([tally[w][1] for w in words], pa.int64())], ["word", "toxic", "clean"])


def _odds(toxic, clean, n_toxic, n_clean):
    return F.log((toxic + F.lit(0.5)) / (n_toxic + 1)) - F.log((clean + F.lit(0.5)) / (n_clean + 1))


def _terms(word):
    """The word and its beginnings."""
    size = F.least(F.length(word), F.lit(MAX_PREFIX))
    beginnings = F.transform(F.sequence(F.lit(MIN_PREFIX), size), lambda n: F.concat(F.lit(" "), F.substring(word, F.lit(1), n)))
    whole = F.when(word.endswith("*"), F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit(" "), word, F.lit(" "))))
    return F.concat(whole, F.when(F.length(word) >= MIN_PREFIX, beginnings).otherwise(F.array().cast("array<string>")))


def _neighbours(train: DataFrame, found: DataFrame) -> DataFrame:
    """(term, count): how many different words stand before each term in toxic texts."""

    def run(batches):
        for b in batches:
            own = set()
            for folded in b.column(0).to_pylist():
                words = folded.split()
                own.update((_stem(w), _stem(before)) for before, w in zip(["", *words], words))
            cols = list(zip(*own)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string())], ["word", "before"])

    pairs = train.filter("toxic").select("text").mapInArrow(tidy(run), "word string, before string")
    pairs = pairs.select(F.explode(_terms(F.col("word"))).alias("term"), "before").join(small(found.select("term")), "term")
    return pairs.distinct().groupBy("term").count()


def _merge(found: dict[str, tuple[int, float]]) -> list[str]:
    """The terms that stand for all of them."""
    longer: dict[str, str] = {}
    for t in sorted(found):  # ' worthless ' lengthens ' worthless', ' wort' lengthens ' wor'
        shorter = t[:-1]
        if shorter in found and found[t][0] >= found[longer.get(shorter, t)][0]:
            longer[shorter] = t
    out: dict[str, None] = {}
    for t in sorted(found, key=lambda t: (len(t), t)):
        if any(t[:n] in out for n in range(2, len(t))):
            continue
        end = t
        while end in longer and found[longer[end]][0] >= 0.9 * found[t][0]:
            end = longer[end]
        out[end] = None
    return list(out)


def merged(scored: DataFrame) -> DataFrame:
    """(term, toxic, odds) without the terms that another one stands for.  One's beginnings share its first letters."""

    def run(batches):
        def out(found):
            rows = [(t, *found[t]) for t in _merge(found)]
            cols = list(zip(*rows)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.float64()))], ["term", "toxic", "odds"])

        last, found = None, {}
        for b in batches:
            for start, term, toxic, odds in zip(*(b.column(i).to_pylist() for i in range(4))):
                if start != last:
                    yield out(found)
                    last, found = start, {}
                found[term] = toxic, odds
        yield out(found)

    keyed = scored.select(F.substring("term", 1, MIN_PREFIX + 1).alias("start"), "term", "toxic", "odds")
    return keyed.repartition("start").sortWithinPartitions("start").mapInArrow(tidy(run), "term string, toxic long, odds double")


def learn_terms(train: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """' word ' and ' beginning' with log odds.  A beginning stands only for what it adds:
    it is lengthened as long as nine tenths of its toxic texts stay with one longer one."""
    counts = train.select("text", "toxic").mapInArrow(tidy(_incidence), "word string, toxic long, clean long")
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share = n_toxic / (n_toxic + n_clean)
    scored = counts.select(F.explode(_terms(F.col("word"))).alias("term"), "toxic", "clean").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    both = F.col("toxic") + F.col("clean")
    surprise = F.col("toxic") * F.log(F.col("toxic") / (both * share)) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (both * (1 - share)))).otherwise(0.0)
    scored = scored.filter((F.col("toxic") > 0) & (2 * surprise >= MIN_SURPRISE)).withColumn("odds", _odds(F.col("toxic"), F.col("clean"), n_toxic, n_clean)).filter(F.col("odds") >= MIN_ODDS)
    found = stage(merged(scored), "terms")
    varied = found.join(_neighbours(train, found), "term").filter(F.col("count") >= MIN_NEIGHBOURS)
    rows = varied.orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "term").limit(MAX_TERMS).collect()
    return {r["term"]: r["odds"] for r in rows}


def automaton(terms: dict[str, float]):
    a = ahocorasick.Automaton()
    for t, w in terms.items():
        a.add_word(t, (len(t), w))
    a.make_automaton()
    return a


def _phrases_around(text: str, start: int) -> list[str]:
    """The hit word with the word before and the word after it."""
    end = text.find(" ", start + 1)
    before = text.rfind(" ", 0, start)
    after = text.find(" ", end + 1)
    out = [text[before + 1 : end]] if before >= 0 else []
    return out + ([text[start + 1 : after]] if after > 0 else [])


def features(folded: str, auto, exceptions: frozenset) -> tuple[float, float]:
    """Sum of the weights of the hits, and of that by 100 words."""
    total = 0.0
    if len(auto):
        last = -1
        for end, (n, weight) in auto.iter(folded):
            start = end - n + 1
            if start == last or exceptions and any(p in exceptions for p in _phrases_around(folded, start)):
                continue
            last = start
            total += weight
    return math.log1p(total), math.log1p(100.0 * total / max(20, folded.count(" ") - 1))


def learn_phrases(train: DataFrame, terms: dict[str, float]) -> frozenset:
    """Word pairs around hits that stand nine times in ten in clean texts, three at least."""

    def around(batches):
        auto = automaton(terms)
        for b in batches:
            out = []
            for folded, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = {p for end, (n, _) in auto.iter(folded) for p in _phrases_around(folded, end - n + 1)} if len(auto) else set()
                out += [(p, int(bool(toxic)), int(not toxic)) for p in own]
            cols = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], ["phrase", "toxic", "clean"])

    pairs = train.select("text", "toxic").mapInArrow(tidy(around), "phrase string, toxic long, clean long").groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    rows = pairs.filter("clean >= 3 and clean >= 9 * toxic").orderBy(F.desc("clean"), "phrase").limit(MAX_PHRASES).collect()
    return frozenset(r["phrase"] for r in rows)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * len(y) * 1e-2 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(y) * 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, terms, exceptions, weights, share):
        self.terms, self.exceptions, self.weights, self.share = terms, exceptions, weights, share


def _folded(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(fold, b.column(1).to_pylist()), pa.string()), b.column(2)], ["doc_id", "text", "toxic"])


def train_model(train: DataFrame) -> Model:
    """train: text, toxic (0 or 1), and doc_id for the order of the bounded sample.

    The folded training texts are written once; every later pass reads them."""
    train = train.filter("toxic is not null").select(F.col("doc_id").cast("string").alias("doc_id"), "text", (F.col("toxic") > 0).alias("toxic"))
    train = stage(train.mapInArrow(tidy(_folded), "doc_id string, text string, toxic boolean"), "folded")
    n = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    n_toxic, n_clean = n.get(True, 0), n.get(False, 0)
    if not n_toxic or not n_clean:
        return Model({}, frozenset(), None, n_toxic / max(1, n_toxic + n_clean))
    terms = learn_terms(train, n_toxic, n_clean)
    exceptions = learn_phrases(train, terms)

    def measured(batches):
        auto = automaton(terms)
        for b in batches:
            x = [features(t, auto, exceptions) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in x], pa.float64()), pa.array([c for _, c in x], pa.float64()), b.column(1)], ["total", "rate", "toxic"])

    order = F.xxhash64("doc_id")
    some = None
    for kind in (True, False):  # ids alone are ordered, then their texts are looked up
        part = train.filter(F.col("toxic") == kind).select("doc_id").orderBy(order, "doc_id").limit(FIT_ROWS)
        some = part if some is None else some.union(part)
    some = train.join(F.broadcast(stage(some.distinct(), "fit-ids")), "doc_id").select("text", "toxic")
    rows = some.mapInArrow(tidy(measured), "total double, rate double, toxic boolean").collect()
    y = np.array([r["toxic"] for r in rows], float)
    x = np.array([(r["total"], r["rate"]) for r in rows], float)
    return Model(terms, exceptions, logistic(x, y), n_toxic / (n_toxic + n_clean))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with `score`."""
    kept = [c for c in docs.columns if c not in ("text", "score")]

    def run(batches):
        auto = automaton(model.terms)
        for b in batches:
            if model.weights is None:
                p = np.full(b.num_rows, model.share)
            else:
                x = np.array([features(fold(t), auto, model.exceptions) for t in b.column("text").to_pylist()]).reshape(-1, 2)
                p = 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ model.weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(p, pa.float64())], [*kept, "score"])

    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept) + "score double"
    return docs.select(*kept, "text").mapInArrow(tidy(run), schema)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    known = stage(labels.filter("toxic is not null and doc_id is not null").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic-labels")
    train = docs.select("doc_id", "text").join(small(known), "doc_id")
    out = score(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), train_model(train))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
