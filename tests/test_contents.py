"""Each content once: words, representatives and what is made for a query."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kinmesh.functions import text as T
from kinmesh.operators import blocking
from kinmesh.operators.normalise import normalise
from kinmesh.plans import catalogue, linkage

SOURCE = "entity_id string, business_name string, business_address string, country string"
ODD = [(None, None, None), ("", "NA", "US"), ("Café Ωmega LLC", "12 Main St 94105", "US"), ("Café Ωmega LLC", "12 Main St 94105", "us"), ("Омега", "улица 5", None), ("Shop", None, "")]


def corpus(n=300):
    rnd = random.Random(3)
    return [(f"S1-{i:04}", f"shop{rnd.randint(0, 40)}", " ".join([f"w{rnd.randint(0, 3)}", f"x{rnd.randint(0, 12)}", f"y{rnd.randint(0, 90)}"][: rnd.randint(1, 3)]), "US") for i in range(n)]


@pytest.mark.parametrize("limit", [3, 50])
def test_bm25_by_heads(spark, limit):
    masters = normalise(spark.createDataFrame(corpus(), SOURCE)).persist()
    frags = normalise(spark.createDataFrame([(r[0].replace("S1", "S2"), *r[1:]) for r in corpus()[:80]] + [("S2-none", "zzz", "", "")], SOURCE)).persist()
    words = lambda df: {r.entity_id: r.w for r in df.select("entity_id", T.edge_trimmed_tokens(F.concat_ws(" ", "name_norm", "addr_norm")).alias("w")).collect()}
    docs, asked = words(masters), words(frags)
    df, mean = {}, sum(map(len, docs.values())) / len(docs)
    for w in docs.values():
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    weigh = lambda t, w: math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / mean))
    want = set()
    for f, q in asked.items():
        s = {i: round(sum(weigh(t, w) for t in sorted(set(q) & set(w))), 9) for i, w in docs.items() if set(q) & set(w)}
        want |= {(f, i, k, round(s[i], 6)) for k, i in enumerate(sorted(s, key=lambda i: (-s[i], i))[:limit])}
    got = {(r.frag_id, r.s1_id, r["rank"], round(r.score, 6)) for r in blocking.bm25(masters, frags, limit=limit).collect()}
    assert got == want


def test_heads_share_postings(spark):
    """A frequent word's postings are met once for each combination of more frequent words, not for each set that holds it."""
    index = spark.createDataFrame([("all", f"s{i:03}", [("all", 1.0)] + [(f"own{i}", 2.0)]) for i in range(200)], "term string, s1_id string, own array<struct<term:string,w:double>>")
    got = blocking._best_of_heads(spark.createDataFrame([("all",)], "head string"), index, 5)
    assert [r.s1_id for r in got.orderBy("s1_id").collect()] == [f"s{i:03}" for i in range(5)]


def test_representatives(spark):
    masters = spark.createDataFrame(corpus(60), SOURCE)
    rows = [(f"S{2 + i % 2}-{i:04}", *r[1:]) for i, r in enumerate(corpus(40) * 3)] + [(f"S2-odd{i}", *r) for i, r in enumerate(ODD * 2)]
    linked = linkage.block(masters, spark.createDataFrame(rows, SOURCE))
    assert linked.members.count() == len(rows) and linked.contents.count() < len(rows) // 2
    s, f = linked.s1, linked.frags
    hits = blocking.key_hits(s, f, linked.idf)
    whole = blocking.fuse([blocking.char_tfidf(s, f), blocking.bm25(s, f), blocking.key_channel(hits)], blocking.confident(hits))
    as_set = lambda df: sorted(tuple(r) for r in df.collect())
    assert as_set(linked.fused) == as_set(whole)
    vendor = linkage.pair_features(linked).select("frag_id", "vendor_is_s3").distinct().collect()
    assert vendor and all(r.vendor_is_s3 == float(r.frag_id.startswith("S3-")) for r in vendor)


def test_odd_records(spark):
    r = {x.entity_id: x for x in normalise(spark.createDataFrame([(str(i), *x) for i, x in enumerate(ODD * 2)], SOURCE)).collect()}
    assert len(r) == 2 * len(ODD) and all(r[str(i)][1:] == r[str(i + len(ODD))][1:] for i in range(len(ODD)))
    assert [r[str(i)].script_flag for i in range(6)] == ["none", "latin", "mixed", "mixed", "cyrillic", "latin"]
    assert r["0"].name_missing and r["0"].country_norm == "" and r["1"].addr_missing and r["3"].country_norm == "us"


def test_only_what_is_asked_for(spark):
    """Counting the words of the masters does not link the fragments."""
    catalogue._runs.clear()
    catalogue.queries()["high_df_tokens"](spark, "/root/testdata/sf0.001").collect()
    assert set(catalogue.run_of(spark, "/root/testdata/sf0.001").linked.seconds) == {"masters"}


def test_long_lists_stop_early(monkeypatch):
    """A long list of unlikely candidates behind a few likely ones: the hits' law grows only as far as a k can be best."""
    import numpy as np

    from kinmesh.operators import decode

    calls = []
    monkeypatch.setattr(decode, "_one_more", lambda law, p, of=decode._one_more: calls.append(1) or of(law, p))
    q = np.array([[0.9] * 4 + [0.02] * 46])
    k, ef = decode.best_k(q, np.zeros(1))
    assert len(calls) < 70  # 50 for the misses, the rest for the hits
    law = lambda p: np.array([1.0]) if not len(p) else np.convolve(law(p[:-1]), [1 - p[-1], p[-1]])
    worth = [sum(a * b * 1.25 * i / (0.25 * (i + j) + n) for i, a in enumerate(law(q[0, :n])) if i for j, b in enumerate(law(q[0, n:]))) for n in range(1, 51)]
    assert k[0] == 1 + int(np.argmax(worth)) and abs(ef[0] - max(worth)) < 1e-9


def test_features_of_a_query_alone(spark):
    """A query that reads some features works out no others, and has the values of the whole table."""
    run = catalogue.Run(spark, "/root/testdata/sf0.001")
    names = ["idf_jaccard", "idf_rarest_shared", "s1_share_address", "rrf_rank", "vendor_is_s3"]
    some = catalogue._features(run, names)
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "jaro" not in plan and "name_partial" not in plan and run._features is None
    text = catalogue._features(run, ["name_ratio", "addr_ratio"])
    assert "jaro" not in text._jdf.queryExecution().optimizedPlan().toString()
    as_set = lambda df: sorted(tuple(r) for r in df.collect())
    before = as_set(some), as_set(text)
    whole = run.features
    assert run._features.count() < whole.count()  # the table holds representatives
    rounded = lambda names: as_set(whole.select("frag_id", "s1_id", *[F.round(n, 6).alias(n) for n in names]))
    assert before == (rounded(names), rounded(["name_ratio", "addr_ratio"]))
