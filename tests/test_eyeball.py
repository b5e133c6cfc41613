"""The eyeball of non-Latin Indian rows shows rare ones and counts all."""

from kinmesh.operators import audit
from kinmesh.plans import catalogue


def test_non_latin_india(spark):
    rows = [(f"S2-{i:05}", "Acme Traders", "5 Gandhi Marg", " INDIA" if i % 2 else "US") for i in range(400)]
    rows += [("S3-00001", "लक्ष्मी Stores", "", "India"), ("S3-00002", "Anand", "மதுரை", "ind"), ("S3-00003", "Магазин", "", "US"), ("S3-00004", None, None, "India"), ("S3-00005", "x", "y", None)]
    got = audit.non_latin_india(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")).collect()
    rates = {r.source: (r.scanned, r.india, r.hits, r.non_latin_rate) for r in got if r.kind == "rate"}
    assert rates == {"S2": (400, 200, 0, 0.0), "S3": (5, 3, 2, 0.666667)}
    assert {r.entity_id for r in got if r.kind == "row"} == {"S3-00001", "S3-00002"}
    flags = {r.script_flag for r in got if r.kind == "row"}
    assert not flags & {"latin", "none", None}


def test_registered(spark):
    kinds = {r.kind for r in catalogue.queries()["eyeball_sample"](spark, "/root/testdata/sf0.001").collect()}
    assert kinds == {"rate"}  # the views hold Latin letters alone
