"""Command line: link a folder of sources, or audit it.

    python -m kinmesh.plans.run link --data DIR --out DIR [--model DIR] [--k 25] [--null 1.0]
    python -m kinmesh.plans.run audit --data DIR

With a ground truth in the folder, link trains a model, saves it with the masters'
statistics under --model, and reports scores over held-out and all fragments; without
one it uses the saved model, or the fused ranks if there is none."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, model, reports, score
from ..operators.normalise import normalise
from ..sources import tsv
from ..sources.staging import stage
from . import linkage


def _truth(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*ground_truth*.tsv")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return tsv.read_ground_truth(spark, sorted(f.getPath().toString() for f in found)[0]) if found is not None and len(found) else None


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]  # reports of a few rows


def link(spark: SparkSession, folder: str, out: str, saved: str | None = None, config: linkage.Config | None = None, model_params: dict | None = None) -> dict:
    config = config or linkage.Config()
    data = tsv.load_dataset(spark, folder)
    s1, frags = data["S1"], data["S2"].unionByName(data["S3"])
    spine = s1.select(F.col("entity_id").alias("s1_id"), "country")
    linked, truth, report = linkage.block(s1, frags, config), _truth(spark, folder), {}
    scores = None
    if truth is not None:
        pairs = model.training_pairs(linkage.pair_features(linked), truth[1])
        pairs = stage(pairs, "pairs")
        train, rest = model.hold_out(pairs)
        scorer = model.PairScorer(**(model_params or {})).fit(train)
        scores = scorer.predict(pairs)
        if saved:
            scorer.save(saved)
            model.save_statistics(saved, **linkage.master_statistics(linked.s1))
        report["importance"] = scorer.importance()
    elif saved:
        statistics = model.load_statistics(spark, saved, "idf", "names", "addresses")
        scores = model.PairScorer.load(saved).predict(linkage.pair_features(linked, statistics))
    predicted = stage(linkage.predict(linked, scores, config), "predicted")
    tsv.write_submission(spine, predicted, f"{out}/matching_results")
    tsv.write_submission(spine, linked.fused, f"{out}/candidate_pairs", "candidate_entity_ids")
    lists = lambda df: df.groupBy("s1_id").agg(F.collect_set("frag_id").alias("ids"))
    blank = spine.select("s1_id", F.array().cast("array<string>").alias("none"))
    whole = lambda df: blank.join(lists(df), "s1_id", "left").select("s1_id", F.coalesce("ids", "none").alias("ids"))
    known = frags.select(F.col("entity_id").alias("frag_id"))
    report["violations"] = score.violations(spine.select("s1_id"), known, whole(predicted), whole(linked.fused)).count()
    if truth is not None:
        s = stage(score.entity_scores(spine, truth[1], predicted), "scores")
        held = rest.select("frag_id").distinct()
        part = score.entity_scores(spine.join(truth[1].join(held, "frag_id", "left_semi"), "s1_id", "left_semi"), truth[1].join(held, "frag_id", "left_semi"), predicted.join(held, "frag_id", "left_semi"))
        report |= {"all": _rows(score.macro_f(s)), "held_out_fragments": _rows(score.macro_f(part)), "slices": _rows(score.macro_slices(s, spine)), "ceiling": _rows(reports.ceiling(spine, truth[1], linked.fused))}
    return report


def audit_folder(spark: SparkSession, folder: str) -> dict:
    """The audit's checks in order, as one dictionary."""
    data = tsv.load_dataset(spark, folder)
    rows = None
    for name, df in data.items():
        own = df.withColumn("source", F.lit(name))
        rows = own if rows is None else rows.unionByName(own)
    columns = F.array(*[F.struct(F.concat_ws(".", "source", F.lit(c)).alias("column"), F.col(c).alias("value")) for c in ("business_name", "business_address")])
    values = rows.select(F.explode(columns).alias("x")).select("x.*")
    n = normalise(data["S1"])
    tokens = audit.document_frequency(n, F.col("name_tokens"))
    out = {
        "scale": _rows(rows.groupBy("source").agg(F.count("*").alias("n"))),
        "literal_na": _rows(audit.na_marks(values)),
        "namespace": audit.namespace({k: v.select("entity_id") for k, v in data.items()}).count(),
        "countries": _rows(audit.countries(rows)),
        "scripts": _rows(audit.script_census(rows.select(F.concat_ws("/", "source", "country").alias("grp"), F.concat_ws(" ", "business_name", "business_address").alias("text")))),
        "placeholders": _rows(audit.placeholders(values)),
        "frequent_tokens": _rows(audit.frequent_tokens(tokens).orderBy(F.desc("df"), "token").limit(20)),
    }
    truth = _truth(spark, folder)
    if truth is not None:
        spine, pairs = truth
        frags = data["S2"].unionByName(data["S3"]).select(F.col("entity_id").alias("frag_id"))
        out |= {
            "multi_owner": audit.multi_owner(pairs).count(),
            "per_vendor": _rows(audit.per_vendor(pairs)),
            "cardinalities": _rows(audit.cardinalities(spine, pairs)),
            "by_country": _rows(audit.cardinality_by_country(data["S1"].select(F.col("entity_id").alias("s1_id"), "country"), pairs)),
            "orphans": _rows(audit.orphans(frags, pairs)),
            "cross_country": audit.cross_country(pairs, normalise(data["S2"].unionByName(data["S3"])), n).count(),
            "unknown_truth_ids": tsv.unknown_truth_ids(pairs, frags).count(),
        }
    return out


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser()
    p.add_argument("what", choices=["link", "audit"])
    p.add_argument("--data", required=True)
    p.add_argument("--out")
    p.add_argument("--model")
    p.add_argument("--k", type=int, default=25)
    p.add_argument("--null", type=float, default=1.0)
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    report = audit_folder(spark, a.data) if a.what == "audit" else link(spark, a.data, a.out, a.model, linkage.Config(k=a.k, null=a.null))
    print(json.dumps(report, ensure_ascii=False, default=str))


if __name__ == "__main__":
    main()
