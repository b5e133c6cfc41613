"""Tab-separated sources and sinks: every field a string, empty is not null, quotes are text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE = ["entity_id", "business_name", "business_address", "country"]


class SanityCheckError(ValueError):
    pass


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(fields, line): lines of the file without its header line and blank last line."""
    header = header_fields(spark, path)
    lines = spark.read.option("lineSep", "\n").text(path).select(F.regexp_replace("value", "\r$", "").alias("line"))
    return lines.filter((F.col("line") != "\t".join(header)) & (F.col("line") != "")).select(F.split("line", "\t", -1).alias("fields"), "line")


def header_fields(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.option("lineSep", "\n").text(path).first()
    return first["value"].rstrip("\r").lstrip("﻿").split("\t") if first else []


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """The four columns; lines with another number of fields are left out (check_source names them)."""
    return _lines(spark, path).filter(F.size("fields") == len(SOURCE)).select(*[F.col("fields")[i].alias(c) for i, c in enumerate(SOURCE)])


def sanity(spark: SparkSession, path: str) -> dict:
    """n_lines after the header of each file, n_bad of them with a wrong number of fields (blank lines
    too), n_headers that are repeated, and the first 20 bad lines as (line number, line).

    Lines are numbered in the scan; what comes to the driver is a count for each split."""
    header = "\t".join(header_fields(spark, path))
    x = spark.read.option("lineSep", "\n").text(path).select(F.monotonically_increasing_id().alias("id"), F.input_file_name().alias("file"), F.regexp_replace("value", "\r$", "").alias("line"))
    bad = F.size(F.split("line", "\t", -1)) != len(SOURCE)
    split = F.shiftright("id", 33).alias("split")
    counts = sorted(x.groupBy(split).agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"), F.count_if(F.col("line") == header).alias("headers"), F.collect_set("file").alias("files")).collect())
    before, starts = 0, {}
    for r in counts:
        starts[r["split"]] = before
        before += r["n"]
    files = len({f for r in counts for f in r["files"]})
    some = x.filter(bad).orderBy("id").limit(20).collect()
    return {
        "n_lines": before - files,
        "n_bad": sum(r["bad"] for r in counts),
        "n_headers": sum(r["headers"] for r in counts) - files,
        "examples": [(starts[r["id"] >> 33] + (r["id"] & (1 << 33) - 1) + 1, r["line"]) for r in some],
    }


def check_source(spark: SparkSession, path: str, raise_on_failure: bool = True) -> dict:
    if header_fields(spark, path) != SOURCE:
        report = {"ok": False, "problem": "header", "n_lines": 0, "n_bad": 0, "n_headers": 0, "examples": []}
    else:
        found = sanity(spark, path)
        problem = "field count" if found["n_bad"] else "row count" if found["n_headers"] or read_source(spark, path).count() != found["n_lines"] else None
        report = {"ok": problem is None, "problem": problem, **found}
    if raise_on_failure and not report["ok"]:
        raise SanityCheckError(f"{path}: {report['problem']}: {report['n_bad']} of {report['n_lines']} lines; {report['examples'][:3]}")
    return report


def load_source(spark: SparkSession, path: str) -> DataFrame:
    check_source(spark, path)
    return read_source(spark, path)


def read_ground_truth(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(spine of s1_id, pairs of s1_id and frag_id) from a file of lists or of pairs, told by its header."""
    header = header_fields(spark, path)
    if len(header) < 2:
        raise SanityCheckError(f"{path}: ground truth needs two columns")
    x = _lines(spark, path).select(F.trim(F.col("fields")[0]).alias("s1_id"), F.coalesce(F.get("fields", F.lit(1)), F.lit("")).alias("ids")).filter("s1_id <> ''")
    lists = {"matched_entity_ids", "candidate_entity_ids"} & set(header)
    split = F.split("ids", ",") if lists else F.array("ids")
    pairs = x.select("s1_id", F.explode(split).alias("frag_id")).select("s1_id", F.trim("frag_id").alias("frag_id")).filter("frag_id <> ''").distinct()
    return x.select("s1_id").distinct(), pairs


def ground_truth_shape(spark: SparkSession, path: str) -> dict:
    """Header fields and number of data rows, whatever the format."""
    return {"header": header_fields(spark, path), "n_rows": _lines(spark, path).count()}


def find_root(spark: SparkSession, *bases: str, require: tuple[str, ...] = ("train", "test")) -> str:
    """The first of base, base/dataset and base/student_resource/dataset that holds the required folders."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for base in bases:
        for folder in (base, f"{base}/dataset", f"{base}/student_resource/dataset"):
            paths = [hadoop.Path(f"{folder}/{name}") for name in require]
            if all(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) for p in paths):
                return folder
    raise FileNotFoundError(f"no folder with {', '.join(require)} under {', '.join(bases)}")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(entity_id) of a source, which names the rows that a submission must have."""
    if header_fields(spark, path)[:1] != ["entity_id"]:
        raise SanityCheckError(f"{path}: the first column is not entity_id")
    return _lines(spark, path).select(F.col("fields")[0].alias("entity_id"))


def submission_problems(spark: SparkSession, path: str, header: str = "matched_entity_ids", source: str | None = None, final: bool = False) -> list[str]:
    """What is wrong with a file before its rows are looked at: it is missing or empty, its header is another
    one, or the file of the masters that a final submission is held against is not there."""
    hadoop, out = spark._jvm.org.apache.hadoop.fs, []
    there = lambda p: (at := hadoop.Path(p)).getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    if not there(path):
        return [f"missing file: {path}"]
    fields = header_fields(spark, path)
    if not fields or fields == [""]:
        return [f"empty file: {path}"]
    if fields != ["source1_entity_id", header]:
        out.append(f"header is {fields}, not source1_entity_id and {header}")
    if final and (source is None or not there(source)):
        out.append("a final submission needs the file of the masters")
    return out


def write_truth(pairs: DataFrame, path: str) -> None:
    """The ground truth as lists, masters and their ids in order."""
    lists = pairs.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("frag_id")), ",").alias("matched_entity_ids"))
    rows = lists.select(F.col("s1_id").alias("source1_entity_id"), "matched_entity_ids").orderBy("source1_entity_id")
    rows.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def unknown_truth_ids(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Fragment ids of the truth that no source holds; known: (frag_id)."""
    return pairs.select("frag_id").distinct().join(known, "frag_id", "left_anti")


def find_source(spark: SparkSession, folder: str, n: int) -> str | None:
    """First of source{n}.tsv, s{n}.tsv, *source{n}*.tsv, *s{n}*.tsv that exists, in any store that Spark reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for pattern in (f"source{n}.tsv", f"s{n}.tsv", f"*source{n}*.tsv", f"*s{n}*.tsv"):
        path = hadoop.Path(f"{folder}/{pattern}")
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        if found is not None and len(found):
            return sorted(f.getPath().toString() for f in found)[0]
    return None


def load_dataset(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    out = {}
    for n in (1, 2, 3):
        path = find_source(spark, folder, n)
        if path is None:
            raise FileNotFoundError(f"no file of source {n} in {folder}")
        out[f"S{n}"] = load_source(spark, path)
    return out


def submission_rows(spine: DataFrame, pairs: DataFrame, header: str = "matched_entity_ids") -> DataFrame:
    """A row for each master, its distinct fragment ids sorted and joined by commas, blank if none."""
    bad = F.when(~F.col("frag_id").rlike("^S[23]-"), F.raise_error(F.concat(F.lit("not a fragment id: "), "frag_id"))).otherwise(F.col("frag_id"))
    lists = pairs.select("s1_id", bad.alias("frag_id")).groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("frag_id")), ",").alias(header))
    return spine.select("s1_id").join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(header, F.lit("")).alias(header))


def write_submission(spine: DataFrame, pairs: DataFrame, path: str, header: str = "matched_entity_ids") -> None:
    """Tab-separated with a header; the spine's `place` column, if it has one, orders the rows.  One file, as the format asks."""
    if spine.groupBy("s1_id").count().filter("count > 1").limit(1).count():
        raise ValueError("a master is listed twice")
    rows = submission_rows(spine, pairs, header)
    if "place" in spine.columns:
        rows = rows.join(spine.select(F.col("s1_id").alias("source1_entity_id"), "place"), "source1_entity_id").orderBy("place").drop("place")
    rows.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, ids) as the file has them, repeats included."""
    if header_fields(spark, path)[:1] != ["source1_entity_id"]:
        raise SanityCheckError(f"{path}: the first column is not source1_entity_id")
    x = spark.read.option("lineSep", "\n").text(path).select(F.split(F.regexp_replace("value", "\r$", ""), "\t", -1).alias("f")).filter("f[0] <> 'source1_entity_id'")
    ids = F.filter(F.split(F.coalesce(F.get("f", F.lit(1)), F.lit("")), ","), lambda i: i != "")
    return x.select(F.col("f")[0].alias("s1_id"), ids.alias("ids"))


def write_source(df: DataFrame, path: str) -> None:
    """Tabs and line ends inside values become spaces."""
    clean = [F.translate(F.coalesce(c, F.lit("")), "\t\n\r", "   ").alias(c) for c in SOURCE]
    df.select(*clean).coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def write_embeddings(df: DataFrame, path: str) -> None:
    df.select("entity_id", F.col("vector").cast("array<float>").alias("vector")).write.mode("overwrite").parquet(path)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("entity_id string, vector array<float>").parquet(path)
