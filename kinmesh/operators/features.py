"""The 29 features of a fragment-master pair, as Columns."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import rules as R

#: The registry, in order; a model is bound to it.
NAMES = [
    "name_ratio", "name_core_ratio", "name_token_set", "name_token_sort", "name_partial", "name_jaro", "addr_ratio", "addr_token_set",
    "rrf_score", "rrf_rank", "idf_jaccard", "idf_shared_sum", "idf_unshared_sum", "idf_rarest_shared",
    "house_state", "unit_state", "postcode_state", "name_number_match", "suffix_state", "acronym", "branch_word_conflict",
    "cand_count", "score_gap_to_best", "is_best_candidate", "s1_share_name_core", "s1_share_address", "vendor_is_s3", "country_known", "script_mixed",
]


def bag_ratio(a: Column, b: Column) -> Column:
    """Twice the characters in common over all characters; 1 if equal, 0 if one is empty."""
    count = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    common = F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda s, c: s + F.when(c == "", 0).otherwise(F.least(count(a, c), count(b, c))))
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(2.0 * common / (F.length(a) + F.length(b)))


def _words(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def token_set(a: Column, b: Column) -> Column:
    x, y = _words(a), _words(b)
    return F.when((a == "") | (b == ""), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def token_sort(a: Column, b: Column) -> Column:
    s = lambda c: F.array_join(F.array_sort(_words(c)), " ")
    return bag_ratio(s(a), s(b))


def partial(a: Column, b: Column) -> Column:
    """Best ratio of the shorter text with a window of its length in the longer one."""
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    n = F.length(short)
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.length(long) - n + 1), lambda i: bag_ratio(short, F.substring(long, i, n))))
    return F.when((a == "") | (b == ""), 0.0).otherwise(best)


def _jw(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach, used, mine = max(len(a), len(b)) // 2 - 1, [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                mine.append(c)
                break
    if not mine:
        return 0.0
    other = [c for c, u in zip(b, used) if u]
    m, swaps = len(mine), sum(x != y for x, y in zip(mine, other)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    seen: dict = {}
    return pd.Series([seen[k] if (k := (x, y)) in seen else seen.setdefault(k, _jw(x or "", y or "")) for x, y in zip(a, b)])


def three_state(a: Column, b: Column) -> Column:
    """0 if either is missing, 1 if equal, 2 if different."""
    x, y = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return F.when((x == "") | (y == ""), 0).when(x == y, 1).otherwise(2)


def postcode_state(a: Column, b: Column) -> Column:
    x, y = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return F.when((x == "") | (y == ""), 0).when(x == y, 1).when(F.substring(x, 1, 3) == F.substring(y, 1, 3), 2).otherwise(3)


def _acronym(a: Column, b: Column) -> Column:
    first = lambda c: F.array_join(F.transform(_words(c), lambda t: F.substring(t, 1, 1)), "")
    one = lambda x, y: (F.size(_words(x)) >= 2) & F.array_contains(_words(y), first(x))
    return F.when(one(a, b) | one(b, a), 1).otherwise(0)


def vendor_is_s3() -> Column:
    return F.when(F.col("frag_id").startswith("S3-"), 1.0).otherwise(0.0)


def _number_text(c: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?U)\d+"), F.lit(0)))), ",")


def pair_features(candidates: DataFrame, frags: DataFrame, s1: DataFrame, idf: DataFrame, name_counts: DataFrame, addr_counts: DataFrame, only: list[str] | None = None) -> DataFrame:
    """frag_id, s1_id and the features of each fused candidate, all of NAMES or `only` these.

    idf: (token, idf); name_counts: (name_core, n); addr_counts: (addr_norm, n): statistics
    of the masters that the model was trained beside.  Token weights are looked up for the
    distinct token lists, not pair by pair.  What none of the features asked for reads is not joined."""
    wanted = [n for n in NAMES if only is None or n in only]
    some = lambda *names: any(n in wanted for n in names)
    fields = ["name_norm", "name_core", "name_tokens", "addr_norm", "postcode", "addr_numbers", "legal_suffixes", "country_norm", "script_flag"]
    f = frags.select(F.col("entity_id").alias("frag_id"), *[F.col(c).alias(f"f_{c}") for c in fields])
    m = s1.select(F.col("entity_id").alias("s1_id"), *[F.col(c).alias(f"s_{c}") for c in fields])
    # what a master's fields alone say is joined to the masters, before pairs carry them
    if some("s1_share_name_core"):
        m = m.join(name_counts.select(F.col("name_core").alias("s_name_core"), F.col("n").alias("name_n")), "s_name_core", "left")
    if some("s1_share_address"):
        m = m.join(addr_counts.select(F.col("addr_norm").alias("s_addr_norm"), F.col("n").alias("addr_n")), "s_addr_norm", "left")
    own = Window.partitionBy("frag_id")
    x = candidates.select("frag_id", "s1_id", "rrf_score", "rrf_rank", F.count("*").over(own).alias("cand_count"), (F.max("rrf_score").over(own) - F.col("rrf_score")).alias("score_gap_to_best"))
    x = x.join(f, "frag_id").join(m, "s1_id")
    fa, sa, fn, sn, fc, sc = (F.col(c) for c in ("f_addr_norm", "s_addr_norm", "f_name_norm", "s_name_norm", "f_name_core", "s_name_core"))
    by_name = {
        "name_ratio": bag_ratio(fn, sn),
        "name_core_ratio": bag_ratio(fc, sc),
        "name_token_set": token_set(fc, sc),
        "name_token_sort": token_sort(fc, sc),
        "name_partial": partial(fc, sc),
        "name_jaro": jaro_winkler(fc, sc),
        "name_number_match": three_state(_number_text(fn), _number_text(sn)),
        "acronym": _acronym(fc, sc),
    }
    # names repeat: what follows from a pair of names alone is worked out once for each distinct pair, and joined once
    weighed = some("idf_jaccard", "idf_shared_sum", "idf_unshared_sum", "idf_rarest_shared")
    if weighed or some(*by_name):
        pair = ["f_name_norm", "s_name_norm", "f_name_core", "s_name_core", "f_name_tokens", "s_name_tokens"]
        named = x.select(*pair).distinct()
        values = [v.alias(n) for n, v in by_name.items() if n in wanted]
        if weighed:
            weights = _weights(named.select(F.col("f_name_tokens").alias("a"), F.col("s_name_tokens").alias("b")).distinct(), idf)
            named = named.join(weights, (F.col("f_name_tokens") == F.col("a")) & (F.col("s_name_tokens") == F.col("b")), "left")
            values += [F.col(n) for n in ("jaccard", "shared", "unshared", "rarest")]
        named = named.select(*[F.col(c).alias(f"own_{c}") for c in pair], *values)
        x = x.join(named, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"own_{c}")) for c in pair]))
    branch = F.array(*map(F.lit, R.BRANCHES))
    only = lambda a, b: F.size(F.array_intersect(F.array_except(a, b), branch)) > 0
    ft, st = F.col("f_name_tokens"), F.col("s_name_tokens")
    units = lambda p: F.array_join(F.col(f"{p}_addr_numbers.units"), ",")
    fs, ss = F.col("f_legal_suffixes"), F.col("s_legal_suffixes")
    values = {
        **{n: F.col(n) for n in by_name},
        "addr_ratio": bag_ratio(fa, sa),
        "addr_token_set": token_set(fa, sa),
        "rrf_score": F.col("rrf_score"),
        "rrf_rank": F.col("rrf_rank"),
        "idf_jaccard": F.coalesce("jaccard", F.lit(0.0)),
        "idf_shared_sum": F.coalesce("shared", F.lit(0.0)),
        "idf_unshared_sum": F.coalesce("unshared", F.lit(0.0)),
        "idf_rarest_shared": F.coalesce("rarest", F.lit(0.0)),
        "house_state": three_state(F.col("f_addr_numbers.house_number"), F.col("s_addr_numbers.house_number")),
        "unit_state": three_state(units("f"), units("s")),
        "postcode_state": postcode_state(F.col("f_postcode"), F.col("s_postcode")),
        "suffix_state": F.when((F.size(fs) == 0) | (F.size(ss) == 0), 0).when(F.arrays_overlap(fs, ss), 1).otherwise(2),
        "branch_word_conflict": F.when(only(ft, st) | only(st, ft), 1).otherwise(0),
        "cand_count": F.col("cand_count"),
        "score_gap_to_best": F.col("score_gap_to_best"),
        "is_best_candidate": F.when(F.col("rrf_rank") == 0, 1).otherwise(0),
        "s1_share_name_core": F.coalesce("name_n", F.lit(1)),
        "s1_share_address": F.coalesce("addr_n", F.lit(1)),
        "vendor_is_s3": vendor_is_s3(),
        "country_known": F.when(F.col("f_country_norm") == F.col("s_country_norm"), 1).otherwise(0),
        "script_mixed": F.when((F.col("f_script_flag") == "mixed") | (F.col("s_script_flag") == "mixed"), 1).otherwise(0),
    }
    return x.select("frag_id", "s1_id", *[values[n].cast("double").alias(n) for n in wanted])


def _weights(pairs: DataFrame, idf: DataFrame) -> DataFrame:
    """(a, b, jaccard, shared, unshared, rarest) for pairs of token lists; unknown tokens weigh as the rarest known."""
    key = F.struct("a", "b").alias("key")
    t = pairs.select(key, F.explode(F.array_union("a", "b")).alias("token"), F.array_intersect("a", "b").alias("both"))
    top = idf.agg(F.coalesce(F.max("idf"), F.lit(1.0)).alias("top"))
    t = t.join(idf.select("token", "idf"), "token", "left").crossJoin(F.broadcast(top)).withColumn("w", F.coalesce("idf", "top"))
    inside = F.array_contains("both", F.col("token"))
    g = t.groupBy("key").agg(F.sum(F.when(inside, F.col("w")).otherwise(0.0)).alias("shared"), F.sum(F.when(~inside, F.col("w")).otherwise(0.0)).alias("unshared"), F.coalesce(F.max(F.when(inside, F.col("w"))), F.lit(0.0)).alias("rarest"))
    return g.select("key.a", "key.b", (F.col("shared") / (F.col("shared") + F.col("unshared"))).alias("jaccard"), "shared", "unshared", "rarest")
