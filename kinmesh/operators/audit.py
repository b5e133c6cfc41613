"""Audits: group-bys over sources and truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T


def document_frequency(docs: DataFrame, tokens: Column) -> DataFrame:
    return docs.select(F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def frequent_tokens(df: DataFrame, share: float = 0.99) -> DataFrame:
    """Tokens whose df is at least the one at place int(n * share) of the sorted dfs."""
    h = df.groupBy("df").agg(F.count("*").alias("m"))  # a row for each distinct df
    total = h.agg(F.sum("m").alias("n"))
    h = h.withColumn("upto", F.sum("m").over(Window.orderBy("df"))).crossJoin(F.broadcast(total))
    cut = h.filter(F.col("upto") > F.least(F.col("n") - 1, F.floor(F.col("n") * share))).agg(F.min("df").alias("cutoff"))
    return df.crossJoin(F.broadcast(cut)).filter("df >= cutoff").select("token", "df")


def differing_tokens(truth: DataFrame, frags: DataFrame, s1: DataFrame) -> DataFrame:
    """(kind, token, n): tokens that true pairs add or drop."""
    x = truth.join(frags.select(F.col("entity_id").alias("frag_id"), F.col("name_tokens").alias("f")), "frag_id").join(s1.select(F.col("entity_id").alias("s1_id"), F.col("name_tokens").alias("s")), "s1_id")
    kinds = F.array(F.struct(F.lit("added").alias("kind"), F.array_except("f", "s").alias("ts")), F.struct(F.lit("dropped").alias("kind"), F.array_except("s", "f").alias("ts")))
    return x.select(F.explode(kinds).alias("k")).select("k.kind", F.explode("k.ts").alias("token")).groupBy("kind", "token").agg(F.count("*").alias("n"))


def countries(records: DataFrame) -> DataFrame:
    """records: source, country -> labels as they are and normalised, with counts."""
    return records.groupBy("source", F.col("country").alias("raw"), F.lower(T.one_space(F.col("country"))).alias("label")).agg(F.count("*").alias("n"))


def cross_country(truth: DataFrame, frags: DataFrame, s1: DataFrame) -> DataFrame:
    f = frags.select(F.col("entity_id").alias("frag_id"), F.col("country_norm").alias("frag_country"))
    s = s1.select(F.col("entity_id").alias("s1_id"), F.col("country_norm").alias("s1_country"))
    return truth.join(f, "frag_id").join(s, "s1_id").filter("frag_country <> s1_country")


def unseen_labels(test: DataFrame, train: DataFrame) -> DataFrame:
    label = F.lower(T.one_space(F.col("country"))).alias("label")
    return test.select(label).distinct().exceptAll(train.select(label).distinct())


def multi_owner(truth: DataFrame) -> DataFrame:
    return truth.groupBy("frag_id").agg(F.count_distinct("s1_id").alias("owners")).filter("owners > 1")


def per_vendor(truth: DataFrame) -> DataFrame:
    """(vendor, masters, most): masters with a fragment of the vendor and the most that one has."""
    n = truth.groupBy("s1_id", F.substring_index("frag_id", "-", 1).alias("vendor")).agg(F.count("*").alias("n"))
    return n.groupBy("vendor").agg(F.count("*").alias("masters"), F.max("n").alias("most"))


def cardinalities(spine: DataFrame, truth: DataFrame) -> DataFrame:
    """(t, n): masters by number of fragments."""
    t = spine.select("s1_id").join(truth.groupBy("s1_id").agg(F.count("*").alias("t")), "s1_id", "left").na.fill(0, ["t"])
    return t.groupBy("t").agg(F.count("*").alias("n"))


def cardinality_by_country(spine: DataFrame, truth: DataFrame) -> DataFrame:
    """spine: s1_id, country.  A row for each country and one, with country null, for all."""
    t = spine.join(truth.groupBy("s1_id").agg(F.count("*").alias("t")), "s1_id", "left").na.fill(0, ["t"])
    n = lambda c: F.count_if(c)
    c = F.col("t")
    return t.rollup("country").agg(F.count("*").alias("n"), n(c == 0).alias("t0"), n(c == 1).alias("t1"), n((c >= 2) & (c <= 4)).alias("t2_4"), n(c >= 5).alias("t5"), F.round(n(c == 0) / F.count("*"), 6).alias("singleton_rate"))


def orphans(frags: DataFrame, truth: DataFrame) -> DataFrame:
    """(vendor, n, n_orphans, rate): fragments that belong to no master."""
    x = frags.select("frag_id").join(truth.select("frag_id", F.lit(1).alias("own")).distinct(), "frag_id", "left").select("own", F.substring_index("frag_id", "-", 1).alias("vendor"))
    return x.groupBy("vendor").agg(F.count("*").alias("n"), (F.count("*") - F.count("own")).alias("n_orphans")).withColumn("rate", F.round(F.col("n_orphans") / F.col("n"), 6))


def script_census(texts: DataFrame) -> DataFrame:
    """texts: grp, text -> rows, rows beyond ASCII, and rows by script."""
    return texts.select("grp", T.has_non_ascii(F.col("text")).alias("beyond"), T.script_flag(F.col("text")).alias("script")).groupBy("grp", "script").agg(F.count("*").alias("n"), F.count_if("beyond").alias("n_non_ascii"))


def placeholders(values: DataFrame, most: int = 3, share: float = 0.01) -> DataFrame:
    """values: column, value -> folded values of at most `most` characters in over `share` of their column's rows."""
    v = values.select("column", T.one_space(T.nfkc_casefold(F.col("value"))).alias("value"))
    n = v.groupBy("column").agg(F.count("*").alias("total"))
    c = v.filter(F.length("value") <= most).groupBy("column", "value").agg(F.count("*").alias("n"))
    return c.join(F.broadcast(n), "column").filter(F.col("n") > share * F.col("total")).select("column", "value", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def na_marks(values: DataFrame) -> DataFrame:
    return values.select("column", F.lower(F.trim("value")).alias("mark")).filter(F.col("mark").isin(R.NA_MARKS)).groupBy("column", "mark").agg(F.count("*").alias("n"))


def namespace(sources: dict[str, DataFrame]) -> DataFrame:
    """(problem, source, entity_id) for ids without their source's prefix, repeated, or in two sources; sources: name -> (entity_id)."""
    rows = None
    for name, df in sources.items():
        ids = df.select(F.lit(name).alias("source"), "entity_id")
        rows = ids if rows is None else rows.union(ids)
    wrong = rows.filter(~F.col("entity_id").startswith(F.concat("source", F.lit("-")))).select(F.lit("wrong_prefix").alias("problem"), "source", "entity_id")
    again = rows.groupBy("source", "entity_id").count().filter("count > 1").select(F.lit("repeated"), "source", "entity_id")
    shared = rows.groupBy("entity_id").agg(F.count_distinct("source").alias("n"), F.min("source").alias("source")).filter("n > 1").select(F.lit("shared"), "source", "entity_id")
    return wrong.union(again).union(shared)


def eyeball(records: DataFrame, n: int = 20, seed: int = 42) -> DataFrame:
    """A fixed sample: the rows whose hashed ids are least."""
    return records.orderBy(F.xxhash64("entity_id", F.lit(seed)), "entity_id").limit(n)


def non_latin_india(records: DataFrame, n: int = 20, seed: int = 42) -> DataFrame:
    """Indian rows whose name and address are not in Latin letters: a fixed sample of n (kind 'row'),
    and for each source ('rate') the rows scanned, the Indian ones, the hits and their share of those."""
    ind = F.coalesce(F.lower(F.trim("country")).startswith("ind"), F.lit(False))
    blob = F.concat_ws(" ", F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit("")))
    flag = F.when(ind, T.script_flag(blob))
    rows = records.withColumn("source", F.substring_index("entity_id", "-", 1)).withColumn("india", ind).withColumn("script_flag", flag)
    rows = rows.withColumn("hit", F.coalesce(~F.col("script_flag").isin("latin", "none"), F.lit(False)))
    rates = rows.groupBy("source").agg(F.count("*").alias("scanned"), F.count_if("india").alias("india"), F.count_if("hit").alias("hits"))
    rates = rates.select(F.lit("rate").alias("kind"), "*", F.round(F.col("hits") / F.greatest("india", F.lit(1)), 6).alias("non_latin_rate"))
    sample = eyeball(rows.filter("hit"), n, seed).select(F.lit("row").alias("kind"), "source", "entity_id", "country", "script_flag", "business_name", "business_address")
    return rates.unionByName(sample, allowMissingColumns=True)


def truth_shape(rows: DataFrame) -> DataFrame:
    """rows: (s1_id, n), the ids that a row of the ground truth names.  One row: rows, masters, whether a
    master has a row of its own (a file of lists), and the mean and most of ids for a master."""
    per = rows.groupBy("s1_id").agg(F.count("*").alias("rows"), F.sum("n").alias("t"))
    out = per.agg(F.sum("rows").alias("n_rows"), F.count("*").alias("n_masters"), F.round(F.avg("t"), 6).alias("mean_t"), F.max("t").alias("max_t"))
    return out.select("n_rows", "n_masters", (F.col("n_rows") == F.col("n_masters")).alias("lists"), "mean_t", "max_t")
