"""Confident key hits by a plan of their own: fewer fields, rare keys alone, ids that repeat."""

from kinmesh.operators import blocking
from kinmesh.plans import linkage
from kinmesh.plans.views import views

RAW = "entity_id string, business_name string, business_address string, country string"


def pairs(df):
    return sorted(map(tuple, df.select("frag_id", "s1_id").collect()))


def test_as_by_the_whole_plan_without_its_stages(spark, sf_dir="/root/testdata/sf0.001"):
    s1, fr = views(spark, sf_dir)
    alone, whole = (linkage.Linked(s1, fr.drop("true_s1")) for _ in range(2))
    got = pairs(alone.sure)
    assert not {"_texts", "s1", "members", "contents", "own_hits"} & alone.__dict__.keys()
    assert got and got == pairs(whole.spread(whole.own_sure))
    assert pairs(whole.sure) == got  # with the texts that are there by now


def test_ids_that_repeat_give_each_pair_once(spark):
    s1 = spark.createDataFrame([("S1-1", "Acme Bakery LLC", "12 Maple Street, 94105", "US"), ("S1-2", "Blue Motors", "7 Cedar Road, 10001", "US"), ("S1-3", None, None, None)], RAW)
    rows = [("S2-1", "Acme Bakery", "12 Maple Street, 94105", "US"), ("S2-1", "Acme Bakery", "12 Maple Street, 94105", "US"), ("S2-1", "Blue Motors", "7 Cedar Road, 10001", "US")]
    rows += [("S2-2", "Blue Motors", "7 Cedar Road, 10001", "US"), ("S2-3", None, "NA", None), ("S2-4", "", "7 Cedar Road, 10001", "US")]
    linked = linkage.Linked(s1, spark.createDataFrame(rows, RAW))
    assert pairs(linked.sure) == [("S2-1", "S1-1"), ("S2-1", "S1-2"), ("S2-2", "S1-2"), ("S2-4", "S1-2")]


def test_a_large_table_is_not_broadcast(spark, monkeypatch):
    from kinmesh.sources import staging

    df = spark.createDataFrame([("a",), ("b",)], "x string")
    assert "broadcast" in staging.small(df)._jdf.queryExecution().logical().toString().lower()
    monkeypatch.setattr(staging, "FEW_CHARACTERS", 1)
    assert "broadcast" not in staging.small(df)._jdf.queryExecution().logical().toString().lower()


def test_confident_buckets_only(spark):
    own = spark.createDataFrame([("k", "a", "b", f"S1-{i}") for i in range(6)] + [("k", "a", "c", "S1-0")], "key_kind string, k1 string, k2 string, entity_id string")
    assert [tuple(r) for r in blocking.key_index(own, blocking.CONFIDENT).collect()] == [("k", "a", "c", "S1-0", 1)]
