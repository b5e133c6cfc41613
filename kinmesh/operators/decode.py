"""Exclusive assignment and exact expected-F0.5 decoding, one row a master."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FLOOR, LAMBDA_TERMS = 0.02, 12
TOP, DECAY = 0.55, 0.55
#: Lists up to this go through the laws of hits and misses, longer ones through an integral.
SHORT = 64


def rank_marginals(fused: DataFrame, top: float = TOP, decay: float = DECAY) -> DataFrame:
    """(frag_id, s1_id, p): a probability from the fused rank alone, without a model."""
    return fused.select("frag_id", "s1_id", F.greatest(top * F.pow(F.lit(decay), F.col("rrf_rank")), F.lit(1e-6)).alias("p"))


def softmax_null(scores: DataFrame, null: float = 1.0) -> DataFrame:
    """(frag_id, s1_id, p) -> pi and pi_null: odds of each master against the others and against none."""
    p = F.least(F.greatest("p", F.lit(0.0)), F.lit(1 - 1e-12))
    w = scores.select("frag_id", "s1_id", (p / (1 - p)).alias("w"))
    z = F.lit(null) + F.sum("w").over(Window.partitionBy("frag_id"))
    return w.select("frag_id", "s1_id", F.when(z > 0, F.col("w") / z).otherwise(0.0).alias("pi"), F.when(z > 0, F.lit(null) / z).otherwise(1.0).alias("pi_null"))


def _let(value: Column, body) -> Column:
    """body over a value that is computed once: an expression inside a lambda would be
    computed anew at each of its calls."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _grow(pmf: Column, p: Column) -> Column:
    """One more trial: stay with 1 - p, move up by one with p."""
    zero = F.array(F.lit(0.0))
    return F.zip_with(F.concat(F.transform(pmf, lambda x: x * (1 - p)), zero), F.concat(zero, F.transform(pmf, lambda x: x * p)), lambda a, b: a + b)


def poisson_binomial(q: Column, start: Column | None = None) -> Column:
    """Probabilities of 0, 1, ... successes of independent trials with probabilities q."""
    start = F.array(F.lit(1.0)) if start is None else start
    return F.aggregate(q, start, lambda m, p: _grow(m, F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))))


def poisson(rate: Column, most: int = LAMBDA_TERMS) -> Column:
    """A Poisson law cut at `most` and scaled to one; rate 0 or less is no event."""
    steps = F.sequence(F.lit(1), F.lit(most))
    raw = F.aggregate(steps, F.array(F.lit(1.0)), lambda a, k: F.array_append(a, F.element_at(a, -1) * rate / k))
    total = lambda r: F.aggregate(r, F.lit(0.0), lambda a, x: a + x)
    scaled = _let(F.struct(raw.alias("raw"), total(raw).alias("sum")), lambda v: F.transform(v["raw"], lambda x: x / v["sum"]))
    return F.when(rate > 0, scaled).otherwise(F.array(F.lit(1.0)))


def best_sets(lists: DataFrame, unseen: Column | float = 0.0) -> DataFrame:
    """lists: s1_id, q (descending) and more -> with k and ef: how many of q to predict, and the expected F0.5 of that.

    One row a master, its arrays in flat NumPy batches.  In short lists the law of the misses
    beyond each k comes from one pass from the back, which appends a trial at a time; the law
    of the hits grows with k.  Masters with equally many candidates go through together.
    Long lists would take the cube of their length so; `best_of_long` takes each alone."""
    import numpy as np
    import pyarrow as pa

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in lists.schema) + "k int, ef double"
    given = lists.withColumn("__unseen", F.lit(unseen).cast("double") if not isinstance(unseen, Column) else unseen.cast("double"))
    names = lists.columns

    def run(batches):
        for b in batches:
            q = b.column("q")
            size = np.asarray(q.value_lengths().fill_null(0))
            at = np.asarray(q.offsets)[:-1]
            flat = np.clip(np.asarray(q.values, np.float64), 0.0, 1.0)
            rate = np.nan_to_num(np.asarray(b.column("__unseen").fill_null(0.0), np.float64))
            k, ef = np.zeros(len(size), np.int32), np.ones(len(size))
            for n in np.unique(size):
                rows = np.flatnonzero(size == n)
                if n > SHORT:
                    for i in rows:
                        k[i], ef[i] = best_of_long(flat[at[i] : at[i] + n], rate[i])
                    continue
                for some in np.array_split(rows, max(1, -(-len(rows) * (n + 1) * (n + 1) // 4_000_000))):
                    k[some], ef[some] = best_k(flat[at[some][:, None] + np.arange(n)], rate[some])
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(k), pa.array(ef)], [*names, "k", "ef"])

    return given.mapInArrow(run, schema)


def best_k(q, rate):
    """For each row of q (rows x n): the smallest k whose rounded expected F0.5 is best, and that value.

    expected(k) = sum over a hits inside and b misses outside of 1.25 a / (0.25 (a + b) + k);
    for k = 0 the chance that there is nothing to find."""
    import numpy as np

    rows, n = q.shape
    most = LAMBDA_TERMS if (rate > 0).any() else 0
    tail = np.zeros((rows, most + 1))
    tail[:, 0] = 1.0
    for i in range(1, most + 1):
        tail[:, i] = tail[:, i - 1] * np.maximum(rate, 0.0) / i
    tail /= tail.sum(axis=1, keepdims=True)
    outside = [tail]
    for i in range(n - 1, -1, -1):
        outside.append(_one_more(outside[-1], q[:, i : i + 1]))
    outside.reverse()
    inside, value = np.ones((rows, 1)), [np.round(outside[0][:, 0], 12)]
    best, sums = value[0], np.cumsum(q, axis=1)
    for k in range(1, n + 1):
        # expected(k) is under 1.25 / k times the sum of the first k, which falls with k as q does: beyond this no k is best
        if (1.25 * sums[:, k - 1] < k * (best - 1e-9)).all():
            break
        inside = _one_more(inside, q[:, k - 1 : k])
        a, b = np.arange(1, k + 1)[:, None], np.arange(outside[k].shape[1])[None, :]
        worth = 1.25 * a / (0.25 * (a + b) + k)
        value.append(np.round(((inside[:, 1:] @ worth) * outside[k]).sum(axis=1), 12))
        best = np.maximum(best, value[-1])
    value = np.stack(value, axis=1)
    k = value.argmax(axis=1)
    return k, value[np.arange(rows), k]


def best_of_long(q, rate):
    """best_k of one list q, in time that grows with its length.

    1 / x is the integral of t^(x - 1) over (0, 1).  With it and t = s^4 the sum over hits and misses
    becomes, for each k of 1 or more, 5 times the integral over s of s^(4k - 1) G(s) H(s): G is the
    product of 1 - q + q s over all candidates, whatever k is, and H the sum of q s / (1 - q + q s) over
    the first k.  All are positive, so nothing cancels; candidates that are as likely enter once."""
    import numpy as np

    n = len(q)
    start = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    each, often = q[start], np.diff(np.concatenate([start, [n]]))
    tail = np.cumprod(np.concatenate([[1.0], np.full(LAMBDA_TERMS, max(rate, 0.0)) / np.arange(1, LAMBDA_TERMS + 1)]))
    tail /= tail.sum()
    v, weight = _towards_one(int(4 * n + q.sum() + LAMBDA_TERMS).bit_length())
    chance = 1 - each[:, None] * v
    with np.errstate(divide="ignore"):
        nothing = np.exp(often @ np.log1p(-each)) * tail[0]
    g = 5 * weight * np.exp(often @ np.log(chance)) * np.polyval(tail[::-1], 1 - v) / (1 - v)
    share = each[:, None] * (1 - v) / chance
    before = np.cumsum(often[:, None] * share, axis=0) - often[:, None] * share
    run = np.repeat(np.arange(len(start)), often)
    log_s, sums = np.log1p(-v), np.cumsum(q)
    k, best, at, step = 0, np.round(nothing, 12), 1, 32
    while at <= n:
        ks = np.arange(at, min(n, at + step - 1) + 1)
        r = run[ks - 1]
        h = before[r] + (ks - start[r])[:, None] * share[r]
        value = np.round((np.exp(4 * ks[:, None] * log_s) * h) @ g, 12)
        top = int(value.argmax())
        if value[top] > best:
            k, best = int(ks[top]), value[top]
        # as in best_k: beyond this no k is best
        if 1.25 * sums[ks[-1] - 1] < ks[-1] * (best - 1e-9):
            break
        at, step = at + step, min(1024, 2 * step)
    return k, best


@cache
def _towards_one(halvings: int):
    """Gauss-Legendre points and weights on (0, 1), as distances from one: panels halve towards one, where s^k falls off."""
    import numpy as np

    x, w = np.polynomial.legendre.leggauss(16)
    edge = np.concatenate([[0.0], 0.5 ** np.arange(halvings, -1, -1)])
    half = np.diff(edge)[:, None] / 2
    return (edge[:-1, None] + half * (1 + x)).ravel(), (half * w).ravel()


def _one_more(law, p):
    """The law of a count after one more trial."""
    import numpy as np

    out = np.zeros((law.shape[0], law.shape[1] + 1))
    out[:, :-1] = law * (1 - p)
    out[:, 1:] += law * p
    return out


def decode(pi: DataFrame, unseen: float | DataFrame = 0.0, floor: float = 0.0) -> DataFrame:
    """(s1_id, frag_id, pi, ef) of each master's best set: the first k in descending order, k the smallest that is best.

    unseen: the rate of matches that no candidate shows, one for all masters or a frame
    (s1_id, rate).  All candidates enter, unless a floor leaves out those below it."""
    live = pi.filter(F.col("pi") >= floor).select("s1_id", F.struct((-F.round("pi", 12)).alias("order"), "frag_id", "pi").alias("x"))
    lists = live.groupBy("s1_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    lists = lists.select("s1_id", F.transform("x", lambda x: x["frag_id"]).alias("frags"), F.transform("x", lambda x: x["pi"]).alias("q"))
    if isinstance(unseen, DataFrame):
        lists = lists.join(unseen.select("s1_id", "rate"), "s1_id", "left")
        best = best_sets(lists, F.coalesce("rate", F.lit(0.0)))
    else:
        best = best_sets(lists, float(unseen))
    taken = F.slice(F.arrays_zip("frags", "q"), F.lit(1), F.col("k"))
    return best.filter("k > 0").select("s1_id", "ef", F.explode(taken).alias("x")).select("s1_id", F.col("x.frags").alias("frag_id"), F.col("x.q").alias("pi"), "ef")


def exclusive(chosen: DataFrame) -> DataFrame:
    """A fragment that several masters chose stays with the likeliest."""
    w = Window.partitionBy("frag_id").orderBy(F.desc(F.round("pi", 12)), "s1_id")
    return chosen.withColumn("n", F.row_number().over(w)).filter("n = 1").select("s1_id", "frag_id", "pi")


def predict(pi: DataFrame, unseen: float | DataFrame = 0.0) -> DataFrame:
    """Best sets of the candidates from FLOOR on, as the original decodes, each fragment with one master."""
    return exclusive(decode(pi, unseen, FLOOR))
