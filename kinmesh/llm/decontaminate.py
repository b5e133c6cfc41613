"""Benchmark decontamination with DataFrame functions only.

Every window of a benchmark item (10 words, or the whole item if it is shorter)
that a document holds marks the words it covers.  The document side probes only
word grams at aligned positions: a window of L words that starts anywhere holds a
gram of g words at a position divisible by s, if g + s - 1 <= L.  So one position
in s is looked up in a broadcast hash set of the grams of all windows, and what
hits is compared word by word with the windows themselves.

Defined results: null and empty texts have no words and are never contaminated;
items without words have no windows; items that repeat an id count once; rows
that repeat a doc_id, or have none, are judged row by row; empty tables give no
rows, or no hits; further columns of the documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, small, stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _aligned(length: int) -> tuple[int, int]:
    """Gram length and stride that no window of so many words escapes."""
    gram = length // 2 + 1
    return gram, length - gram + 1


def _grams(length: int) -> Column:
    """Hashes of the grams of a window `win`, one for each offset an aligned position can have in it."""
    gram, stride = _aligned(length)
    return F.transform(F.sequence(F.lit(0), F.lit(stride - 1)), lambda o: F.xxhash64(F.slice("win", o + 1, gram)))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(len, win array of words, items array of item_id), staged; one row a distinct window."""
    n = F.size("w")
    spread = F.when(n >= window, F.transform(F.sequence(F.lit(0), n - window), lambda i: F.slice("w", i + 1, window))).when(n > 0, F.array("w"))
    items = benchmark.select(F.col("item_id"), words_of(F.col("text")).alias("w"))
    found = items.select("item_id", F.explode(spread).alias("win"))
    return stage(found.groupBy("win").agg(F.collect_set(F.col("item_id").cast("string")).alias("items")).select(F.size("win").alias("len"), "win", "items"), "windows")


def _key() -> list[Column]:
    """Rows that agree in this agree in what they hold; rows that merely share a doc_id are told apart."""
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"), F.xxhash64("text", F.length("text")).alias("__text")]


def _probes(length: int) -> Column:
    """(gram hash, window length, position) at each aligned position of `w`."""
    g, s = _aligned(length)
    at = F.when(F.size("w") >= g, F.sequence(F.lit(0), F.size("w") - g, F.lit(s))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda p: F.struct(F.xxhash64(F.slice("w", p + 1, g)).alias("gram"), F.lit(length).alias("glen"), p.alias("p")))


def hits(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW) -> DataFrame:
    """The columns `keep` with n_words, n_hit (words inside an occurring window) and
    item_ids (sorted strings), one row for each row of docs.

    Words stay in their document's row: what is joined with the grams is (key, position,
    hash) alone.  The documents of the few probes that hit are read once more, and only
    their windows around the hits leave the row."""
    key = ["__id", "__text"]
    windows = item_windows(benchmark, window)
    lengths = [r[0] for r in windows.select("len").distinct().collect()]  # at most `window` values
    grams = windows.select(F.lit(0).cast("long").alias("gram"), F.lit(0).alias("glen")).limit(0)
    for n in lengths:
        grams = grams.union(windows.filter(F.col("len") == n).select(F.explode(_grams(n)), F.lit(n)))
    known = small(stage(grams.distinct().withColumn("known", F.lit(True)), "grams"))

    base = docs.select(*_key(), F.struct(*keep).alias("doc"), words_of(F.col("text")).alias("w"))
    # the first probe stands for the document itself; no gram has its length
    itself = F.array(F.struct(F.xxhash64(*key).alias("gram"), F.lit(0).alias("glen"), F.lit(-1).alias("p")))
    spread = base.select(*key, "doc", F.size("w").cast("long").alias("n_words"), F.explode(F.concat(itself, *map(_probes, lengths))).alias("x"))
    met = spread.select(*key, "doc", "n_words", "x.*").join(known, ["gram", "glen"], "left").filter("known or p < 0")
    met = stage(met.select(*key, F.when(F.col("p") < 0, F.col("doc")).alias("doc"), "n_words", "glen", "p"), "probed")

    tried = stage(met.filter("p >= 0").groupBy(*key).agg(F.collect_set(F.struct("glen", "p")).alias("probes")), "hit-probes")

    def around(x: Column) -> Column:
        """The windows that hold the gram at x."""
        stride = F.lit(1)
        for length in lengths:
            stride = F.when(x["glen"] == length, F.lit(_aligned(length)[1])).otherwise(stride)
        fits = F.filter(F.sequence(x["p"] - stride + 1, x["p"]), lambda i: (i >= 0) & (i + x["glen"] <= F.size("w")))
        return F.transform(fits, lambda i: F.struct(i.alias("i"), x["glen"].alias("len"), F.slice("w", i + 1, x["glen"]).alias("win")))

    again = docs.select(*_key(), "text").join(small(tried), key).select(*key, words_of(F.col("text")).alias("w"), "probes")
    found = again.select(*key, F.explode(F.flatten(F.transform("probes", around))).alias("x")).select(*key, "x.*")
    found = found.join(small(windows), ["len", "win"]).select(*key, "i", "len", "items")
    spans = found.groupBy(*key).agg(F.array_sort(F.collect_set(F.struct("i", "len"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["end"], x["i"] + x["len"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), x["i"] + x["len"] - F.greatest(a["end"], x["i"]))).alias("n"),
        ),
        lambda a: a["n"],
    )
    per_text = small(stage(spans.select(*key, covered.alias("n_hit"), "item_ids"), "hits"))
    out = met.filter("p < 0").join(per_text, key, "left")
    none = F.array().cast("array<string>")
    return out.select("doc.*", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that hold no window of the benchmark, with their own columns."""
    key = ["__id", "__text"]
    named = docs.select(*_key(), "doc_id", "text")
    bad = hits(named, benchmark, key, window).filter("n_hit > 0").select(*key).distinct()
    return docs.select("*", *_key()).join(small(stage(bad, "contaminated")), key, "left_anti").select(*docs.columns)


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = hits(docs.select("doc_id", "text"), benchmark, ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
"""
