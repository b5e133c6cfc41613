"""Macro F0.5, slices and validation of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entity_f(t: Column, p: Column, tp: Column) -> Column:
    """F0.5 of one master from counts; nothing to find and nothing found is 1."""
    return F.when((t == 0) & (p == 0), 1.0).otherwise(1.25 * tp / (0.25 * t + p))


def entity_scores(spine: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """(s1_id, t, p, tp, f) for each master of the spine; truth and predicted are (s1_id, frag_id)."""
    both = truth.select("s1_id", "frag_id").distinct().withColumn("t", F.lit(1)).join(predicted.select("s1_id", "frag_id").distinct().withColumn("p", F.lit(1)), ["s1_id", "frag_id"], "full")
    n = both.groupBy("s1_id").agg(F.count("t").alias("t"), F.count("p").alias("p"), F.sum(F.when(F.col("t").isNotNull() & F.col("p").isNotNull(), 1).otherwise(0)).alias("tp"))
    out = spine.select("s1_id").distinct().join(n, "s1_id", "left").na.fill(0, ["t", "p", "tp"])
    return out.withColumn("f", entity_f(F.col("t"), F.col("p"), F.col("tp")))


def macro_f(scores: DataFrame) -> DataFrame:
    single = F.avg(F.when(F.col("t") == 0, F.col("f")))
    return scores.agg(F.count("*").alias("n"), F.round(F.avg("f"), 6).alias("macro_f05"), F.round(single, 6).alias("singleton_accuracy"))


def cardinality(t: Column) -> Column:
    return F.when(t == 0, "t=0").when(t == 1, "t=1").when(t <= 4, "t=2-4").otherwise("t>=5")


def country_slice(c: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit("<missing>"))


def macro_slices(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """(slice, value, n, macro_f05) by number of true fragments and by country, in one pass."""
    x = scores.join(labels.select("s1_id", "country"), "s1_id", "left").select("f", cardinality(F.col("t")).alias("c"), country_slice(F.col("country")).alias("l"))
    x = x.select("f", F.explode(F.array(F.struct(F.lit("cardinality").alias("slice"), F.col("c").alias("value")), F.struct(F.lit("country").alias("slice"), F.col("l").alias("value")))).alias("s"))
    return x.groupBy("s.slice", "s.value").agg(F.count("*").alias("n"), F.round(F.avg("f"), 6).alias("macro_f05"))


def vendor_breakdown(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    vendor = F.substring_index("frag_id", "-", 1)
    t = truth.groupBy(vendor.alias("vendor")).agg(F.count("*").alias("n_true"))
    p = predicted.groupBy(vendor.alias("vendor")).agg(F.count("*").alias("n_predicted"))
    return t.join(p, "vendor", "full").na.fill(0)


def violations(spine: DataFrame, known: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(problem, s1_id, detail) over list-shaped frames (s1_id, ids): one row a violation.

    spine: (s1_id); known: (frag_id)."""
    def row(df, problem, detail):
        return df.select(F.lit(problem).alias("problem"), "s1_id", detail.cast("string").alias("detail"))

    none = F.lit(None)
    long = matches.select("s1_id", F.explode("ids").alias("frag_id"))
    out = [row(matches.groupBy("s1_id").count().filter("count > 1"), "duplicate_row", F.col("count"))]
    out.append(row(spine.join(matches, "s1_id", "left_anti"), "missing_row", none))
    out.append(row(matches.join(spine, "s1_id", "left_anti"), "extra_row", none))
    out.append(row(matches.filter(F.size("ids") > F.size(F.array_distinct("ids"))), "repeated_id", none))
    out.append(row(long.filter("frag_id not like 'S2-%' and frag_id not like 'S3-%'"), "wrong_prefix", F.col("frag_id")))
    out.append(row(long.filter("frag_id <> trim(frag_id)"), "stray_space", F.col("frag_id")))
    out.append(row(long.join(known, "frag_id", "left_anti"), "unknown_id", F.col("frag_id")))
    wide = candidates.select("s1_id", F.col("ids").alias("offered"))
    extra = matches.join(wide, "s1_id", "left").select("s1_id", F.explode(F.array_except("ids", F.coalesce("offered", F.array().cast("array<string>")))).alias("frag_id"))
    out.append(row(extra, "not_a_candidate", F.col("frag_id")))
    union = out[0]
    for o in out[1:]:
        union = union.union(o)
    return union
