"""What the driver holds between stages."""

from kinmesh.sources.staging import stage


def test_a_stage_leaves_no_garbage(spark):
    """Garbage that is old, which only a full collection finds, is gone with the stage."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    rows = spark.range(100).selectExpr("id % 7 AS k", "id").groupBy("k").count()
    for _ in range(3):  # a first write loads classes, which has the JVM collect by itself
        stage(rows, "first")
    held = jvm.java.lang.Object()
    seen = jvm.java.lang.ref.WeakReference(held)
    jvm.java.lang.System.gc()  # it outlives this one, and is old
    gateway.detach(held)
    out = stage(rows, "garbage")
    assert seen.get() is None and out.count() == 7
