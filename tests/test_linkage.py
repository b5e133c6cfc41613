"""The linkage operators on small frames with known results."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from kinmesh.functions import text as T
from kinmesh.operators import audit, blocking, decode, features, model, proxy, reports, score
from kinmesh.operators.normalise import normalise
from kinmesh.plans import linkage
from kinmesh.sources import tsv
from kinmesh.streaming import chunks

SOURCE = "entity_id string, business_name string, business_address string, country string"
S1 = [
    ("S1-1", "Zephyr Ceramics LLC", "120 Willow St, Eastbrook 94105", "US"),
    ("S1-2", "Oakmoss Traders Pvt Ltd", "5 Tilak Marg, Solapur 422001", "India"),
    ("S1-3", "Cafe Etoile SARL", "2 Rue Jules Verne, Beaulieu 75008", "France"),
    ("S1-4", "Hilltop Clinic", "88 Elm Ave, Eastbrook 94105", "US"),
]


def records(spark, rows):
    return normalise(spark.createDataFrame([(f"S1-{i}", *r) for i, r in enumerate(rows)], SOURCE)).orderBy("entity_id").collect()


@pytest.fixture(scope="module")
def masters(spark):
    return normalise(spark.createDataFrame(S1, SOURCE)).persist()


def frags(spark, *rows):
    return normalise(spark.createDataFrame([(f"S2-{i}", *r) for i, r in enumerate(rows, 1)], SOURCE))


def test_names(spark):
    rows = [("Société Régionale SA", "", ""), ("Oakmoss Traders Pvt Ltd", "", ""), ("Baker & Sons", "", ""), ("O’Neill", "", ""), ("enterprises", "", ""), ("Zephyr L.L.C.", "", ""), ("Zephyr (P) Ltd", "", ""), ("Madurai (North) Weavers Private-Limited", "", ""), ("M/s Shree Lakshmi Traders", "", ""), ("zep​hyr", "", "")]
    r = records(spark, rows)
    assert (r[0].name_norm, r[0].name_core, r[0].name_core_ascii, r[0].legal_suffixes, r[0].suffix_countries) == ("société régionale sa", "société régionale", "societe regionale", ["sa"], ["FR"])
    assert "pvt ltd" in r[1].legal_suffixes and r[1].name_core == "oakmoss"
    assert r[2].name_norm == "baker and sons" and r[3].name_norm == "o'neill"
    assert r[4].name_core == "enterprises" and r[5].legal_suffixes == ["l l c"] and r[6].legal_suffixes == ["p ltd"]
    assert r[7].name_core == "madurai north weavers" and r[8].name_tokens == ["shri", "lakshmi"] and r[9].name_norm == "zephyr"


def test_native_suffix(spark):
    r = records(spark, [("लक्ष्मी प्राइवेट लिमिटेड", "", "India")])[0]
    assert r.name_core == "लक्ष्मी" and r.script_flag == "devanagari" and r.suffix_countries == ["IN"]


def test_addresses(spark):
    rows = [("a", "12 Willow St, 94105", "US"), ("a", "9 Birch Rd, Solapur 422001", "India"), ("a", "4 Quayside Blvd 75008 CEDEX", "France"), ("a", "120 Willow St, Ste 200 94105-1234", "Atlantis"), ("a", "near the bus stand", ""), ("a", "NA", "US"), ("a", "Flat 3b #7 22/4 Nehru Nagar", "")]
    r = records(spark, rows)
    assert [x.addr_norm for x in r[:3]] == ["12 willow street 94105", "9 birch road solapur 422001", "4 quayside boulevard 75008 cedex"]
    assert [x.postcode for x in r] == ["94105", "422001", "75008", "94105", None, None, None]
    assert r[2].addr_numbers.has_cedex and r[3].addr_numbers.house_number == "120" and r[3].addr_numbers.units == ["200"]
    assert r[4].landmark_flag and r[5].addr_missing and r[5].addr_norm == "" and not r[0].landmark_flag
    assert r[6].addr_numbers.units == ["3b", "7"] and r[6].addr_numbers.house_number == "22/4"


def test_phonetic_and_placeholders(spark):
    p = T.phonetic
    assert p("agarwal") == p("aggarwal") and p("shree") == p("shri") and p("oakmoss") != p("ironwood") and p("") == ""
    values = ["", "-", "0", "NA", "None", "null", "n/a", "  ", "--", "000", "NA Foods", "Zero Degrees Cafe", "A1 Traders"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = [r.p for r in df.select("i", T.placeholder(T.nfkc_casefold(F.col("v"))).alias("p")).orderBy("i").collect()]
    assert got == [True] * 10 + [False] * 3
    rows = spark.createDataFrame([("c", "NA")] * 20 + [("c", f"value {i}") for i in range(80)], "column string, value string")
    assert [(r.value, r.n) for r in audit.placeholders(rows).collect()] == [("na", 20)]


def test_char_grams(spark):
    got = spark.createDataFrame([("ab abcd",)], "v string").select(T.char_grams(F.col("v"))).first()[0]
    assert sorted(got) == sorted([" ab", "ab ", " ab ", " ab", "abc", "bcd", "cd ", " abc", "abcd", "bcd ", " abcd", "abcd "])


def test_channels(spark, masters):
    f = frags(spark, ("Zephyr Ceramisc LLC", "120 Willow Street, 94105", "US"), ("Hilltop clinic", "", "Atlantis"))
    char = blocking.char_tfidf(masters, f)
    assert char.filter("frag_id = 'S2-1' and rank = 0").first().s1_id == "S1-1"
    assert blocking.bm25(masters, f).filter("frag_id = 'S2-2' and rank = 0").first().s1_id == "S1-4"
    idf = blocking.idf(masters, T.edge_trimmed_tokens(F.col("name_norm")))
    hits = blocking.key_hits(masters, f, idf)
    assert {(r.frag_id, r.s1_id) for r in blocking.confident(hits).collect()} == {("S2-1", "S1-1")}
    nowhere = frags(spark, ("Zephyr", "NA", ""), ("Zephyr", "-", ""))
    assert blocking.keys(nowhere, idf).count() == 0
    with pytest.raises(blocking.DenseUnavailable):
        blocking.dense(None, None)


def test_bucket_cap_and_df_pruning(spark):
    many = normalise(spark.createDataFrame([(f"S1-{i}", f"Shop{i}", "1 Main Street, 94105", "US") for i in range(250)], SOURCE))
    idf = blocking.idf(many, T.edge_trimmed_tokens(F.col("name_norm")))
    assert blocking.key_hits(many, frags(spark, ("Other", "1 Main Street, 94105", "US")), idf).count() == 0
    docs = normalise(spark.createDataFrame([(f"S1-{i}", f"uniq{i}", f"main road nagar city {10000 + i}", "") for i in range(2000)], SOURCE))
    got = blocking.bm25(docs, frags(spark, ("uniq7", "main road nagar city", ""))).collect()
    assert [r.s1_id for r in got] == ["S1-7"]


def test_fusion(spark):
    c = "frag_id string, s1_id string, rank int"
    a = spark.createDataFrame([("f", "S1-1", 0), ("f", "S1-2", 1)], c)
    b = spark.createDataFrame([("f", "S1-2", 0)], c)
    none = spark.createDataFrame([], "frag_id string, s1_id string")
    got = blocking.fuse([a, b], none, 2).orderBy("rrf_rank").collect()
    assert [r.s1_id for r in got] == ["S1-2", "S1-1"] and got[0].rrf_score == pytest.approx(1 / 61 + 1 / 60, abs=1e-9)
    deep = spark.createDataFrame([("f", f"S1-{i:02}", i) for i in range(50)], c)
    got = blocking.fuse([deep], spark.createDataFrame([("f", "S1-49"), ("f", "S1-00")], "frag_id string, s1_id string"), 5).collect()
    assert len(got) == 6 and {(r.s1_id, r.rrf_rank) for r in got if r.forced} == {("S1-49", 5)}


def test_reports(spark):
    pairs = "s1_id string, frag_id string"
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-2", "S3-1")], pairs)
    cand = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S3-1")], pairs)
    assert reports.completeness(truth, cand).first().pair_completeness == pytest.approx(2 / 3, abs=1e-6)
    ten = spark.range(10)
    assert reports.reduction(cand, ten, ten).first().reduction_ratio == 0.98
    truth = spark.createDataFrame([(f"S1-{i}", f"S2-{i}-{j}") for i in range(10) for j in range(4)], pairs)
    spine = truth.select("s1_id").distinct()
    row = reports.ceiling(spine, truth, truth.filter("frag_id not like '%-3'")).first()
    assert row.entity_ceiling == 0 and row.macro_f05_ceiling == pytest.approx(1.25 * 3 / 4, abs=1e-6)
    counts = spark.createDataFrame([("S1-1", f) for f in ("a", "b", "b", "c", "c", "c")], pairs)
    row = reports.per_fragment(spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "frag_id string"), counts).first()
    assert (row.n, row.least, row.most, row.n_zero, row.p50, row.p95) == (4, 0, 3, 1, 2, 3)


def pair_of(spark, a, b):
    s, f = normalise(spark.createDataFrame([("S1-1", *b)], SOURCE)), normalise(spark.createDataFrame([("S2-1", *a)], SOURCE))
    cand = spark.createDataFrame([("S2-1", "S1-1", 0.1, 0)], "frag_id string, s1_id string, rrf_score double, rrf_rank int")
    stats = linkage.master_statistics(s)
    return features.pair_features(cand, f, s, stats["idf"], stats["names"], stats["addresses"]).first()


def test_features(spark):
    a, b, c = ("Shree Lakshmi Traders Pvt Ltd", "5 Tilak Marg, Solapur 422001", "India"), ("Shri Lakshmi Traders Private Limited", "5 Tilak Marg, Solapur 422001", "India"), ("Zephyr Ceramics LLP", "120 Willow St Ste 210, Eastbrook 94105", "US")
    x, y = pair_of(spark, a, b), pair_of(spark, a, c)
    assert (x.postcode_state, x.house_state, x.country_known) == (1, 1, 1) and (y.postcode_state, y.house_state) == (3, 2)
    assert x.name_core_ratio > y.name_core_ratio and x.idf_jaccard == 1 and y.idf_jaccard == 0
    assert pair_of(spark, a, ("Zephyr", "", "")).house_state == 0
    assert pair_of(spark, ("Zephyr LLC", "", ""), ("Zephyr LLP", "", "")).suffix_state == 2
    assert pair_of(spark, ("IBM", "", ""), ("International Business Machines", "", "")).acronym == 1
    assert pair_of(spark, ("A", "1 X 422009", ""), ("A", "1 X 422001", "")).postcode_state == 2
    assert len(x.asDict()) == 2 + len(features.NAMES)


def test_jaro_winkler():
    assert features._jw("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert features._jw("dixon", "dicksonx") == pytest.approx(0.8133, abs=1e-4)
    assert features._jw("", "a") == 0 and features._jw("a", "a") == 1


def test_model(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(f"S2-{i}", f"S1-{i}-{j}", float(j == 0), *[rnd.random() + (j == 0) for _ in features.NAMES]) for i in range(60) for j in range(2)]
    pairs = spark.createDataFrame(rows, ["frag_id", "s1_id", "label", *features.NAMES])
    for backend in ("gbt", "logistic"):
        m = model.PairScorer(backend, **({"maxIter": 3} if backend == "gbt" else {})).fit(pairs)
        p = m.predict(pairs).join(pairs, ["frag_id", "s1_id"]).groupBy("label").agg(F.avg("p").alias("p")).collect()
        assert {r.label: r.p > 0.5 for r in p} == {1.0: True, 0.0: False}
        m.save(str(tmp_path / backend))
        assert model.PairScorer.load(str(tmp_path / backend)).predict(pairs).count() == 120
    assert m.importance() == {}
    with pytest.raises(ValueError):
        model.PairScorer().fit(pairs.filter("label = 1"))
    spark.createDataFrame([("gbt", ["other"])], "backend string, features array<string>").write.mode("overwrite").parquet(str(tmp_path / "gbt/registry"))
    with pytest.raises(ValueError):
        model.PairScorer.load(str(tmp_path / "gbt"))
    train, rest = model.hold_out(pairs)
    assert train.join(rest, "frag_id", "left_semi").count() == 0 and train.count() + rest.count() == 120


def brute_ef(q, k, rate=0):
    total = 0.0
    for bits in itertools.product((0, 1), repeat=len(q)):
        p = 1.0
        for b, x in zip(bits, q):
            p *= x if b else 1 - x
        tp, t = sum(bits[:k]), sum(bits)
        total += p * ((1.0 if t == 0 else 0.0) if k == 0 else 1.25 * tp / (0.25 * t + k))
    return total


def test_decoder(spark):
    df = spark.createDataFrame([([0.9, 0.5],)], "q array<double>")
    assert df.select(decode.poisson_binomial(F.col("q"))).first()[0] == pytest.approx([0.05, 0.5, 0.45])
    rnd = random.Random(2)
    rows = [(i, sorted((rnd.random() for _ in range(rnd.randint(1, 6))), reverse=True)) for i in range(25)]
    rows += [(30, []), (31, [0.7] * 4), (32, [1.5, -0.2])]
    for r in decode.best_sets(spark.createDataFrame(rows, "i int, q array<double>").repartition(2)).collect():
        q = [min(1.0, max(0.0, x)) for x in r.q]
        values = [round(brute_ef(q, k), 9) for k in range(len(q) + 1)]
        assert r.ef == pytest.approx(max(values), abs=1e-8) and r.k == values.index(max(values))
    lists = spark.createDataFrame([("m1", [0.6]), ("m2", [0.6])], "s1_id string, q array<double>")
    got = {r.s1_id: r.ef for r in decode.best_sets(lists, F.when(F.col("s1_id") == "m2", 2.0)).collect()}
    law = [math.exp(-2) * 2**b / math.factorial(b) for b in range(13)]
    assert got["m1"] == pytest.approx(0.6) and got["m2"] == pytest.approx(0.6 * sum(p * 1.25 / (0.25 * (1 + b) + 1) for b, p in enumerate(law)) / sum(law))
    pi = [("m1", "a", 0.9), ("m1", "b", 0.5), ("m2", "a", 0.1), ("m2", "c", 0.05), ("m3", "d", 0.95), ("m3", "e", 0.93), ("m3", "f", 0.9), ("m3", "g", 0.88), ("m4", "h", 0.019)]
    got = {}
    for r in decode.decode(spark.createDataFrame(pi, "s1_id string, frag_id string, pi double")).collect():
        got.setdefault(r.s1_id, set()).add(r.frag_id)
    assert got["m1"] == {"a"} and "m2" not in got and len(got["m3"]) >= 3 and "m4" not in got
    rates = spark.createDataFrame([("m1", 5.0)], "s1_id string, rate double")
    by_rate = {(r.s1_id, r.frag_id): r.ef for r in decode.decode(spark.createDataFrame(pi, "s1_id string, frag_id string, pi double"), rates).collect()}
    plain = {(r.s1_id, r.frag_id): r.ef for r in decode.decode(spark.createDataFrame(pi, "s1_id string, frag_id string, pi double")).collect()}
    assert by_rate["m1", "a"] < plain["m1", "a"] and by_rate["m3", "d"] == plain["m3", "d"]


def test_poisson(spark):
    out = spark.createDataFrame([(0.0,), (1.5,)], "r double").select(decode.poisson(F.col("r"))).collect()
    assert out[0][0] == [1.0] and len(out[1][0]) == 13 and sum(out[1][0]) == pytest.approx(1)


def test_softmax_and_guard(spark):
    p = spark.createDataFrame([("f", "S1-a", 0.8), ("f", "S1-b", 0.6)], "frag_id string, s1_id string, p double")
    rows = decode.softmax_null(p).collect()
    assert sum(r.pi for r in rows) + rows[0].pi_null == pytest.approx(1)
    chosen = spark.createDataFrame([("S1-a", "f", 0.7), ("S1-b", "f", 0.2)], "s1_id string, frag_id string, pi double")
    assert [r.s1_id for r in decode.exclusive(chosen).collect()] == ["S1-a"]


@pytest.mark.parametrize("t,p,tp,want", [(0, 0, 0, 1), (0, 1, 0, 0), (1, 0, 0, 0), (1, 1, 1, 1), (1, 2, 1, 1.25 / 2.25), (1, 1, 0, 0), (2, 1, 1, 1.25 / 1.5), (2, 2, 2, 1), (2, 3, 2, 2.5 / 3.5), (4, 1, 1, 0.625), (4, 3, 3, 0.9375)])
def test_entity_f(spark, t, p, tp, want):
    row = spark.createDataFrame([(t, p, tp)], "t int, p int, tp int")
    assert row.select(score.entity_f(F.col("t"), F.col("p"), F.col("tp"))).first()[0] == pytest.approx(want)


def test_macro(spark):
    pairs = "s1_id string, frag_id string"
    spine = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "s1_id string")
    s = score.entity_scores(spine, spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-2")], pairs), spark.createDataFrame([("S1-1", "S2-1")], pairs))
    row = score.macro_f(s).first()
    assert row.macro_f05 == pytest.approx(2 / 3, abs=1e-6) and row.singleton_accuracy == 1


def test_writer_and_validator(spark, tmp_path):
    spine = spark.createDataFrame([("S1-1", 0), ("S1-2", 1), ("S1-3", 2)], "s1_id string, place int")
    pairs = spark.createDataFrame([("S1-1", "S3-4"), ("S1-1", "S2-9"), ("S1-1", "S3-4")], "s1_id string, frag_id string")
    out = str(tmp_path / "out")
    tsv.write_submission(spine, pairs, out)
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-9,S3-4\nS1-2\t\nS1-3\t\n"
    back = tsv.read_submission(spark, out)
    assert {r.s1_id: r.ids for r in back.collect()} == {"S1-1": ["S2-9", "S3-4"], "S1-2": [], "S1-3": []}
    with pytest.raises(ValueError):
        tsv.write_submission(spine.union(spine), pairs, out)
    with pytest.raises(Exception, match="not a fragment id"):
        tsv.submission_rows(spine, spark.createDataFrame([("S1-1", "S1-2")], "s1_id string, frag_id string")).collect()
    lists = "s1_id string, ids array<string>"
    m = spark.createDataFrame([("S1-1", ["S2-1", "S2-1"]), ("S1-1", ["X-1"]), ("S1-9", ["S2-7"])], lists)
    c = spark.createDataFrame([("S1-1", ["S2-1"]), ("S1-9", [])], lists)
    found = {(r.problem, r.s1_id) for r in score.violations(spine.select("s1_id"), spark.createDataFrame([("S2-1",)], "frag_id string"), m, c).collect()}
    assert found == {("duplicate_row", "S1-1"), ("missing_row", "S1-2"), ("missing_row", "S1-3"), ("extra_row", "S1-9"), ("repeated_id", "S1-1"), ("wrong_prefix", "S1-1"), ("unknown_id", "S1-1"), ("unknown_id", "S1-9"), ("not_a_candidate", "S1-1"), ("not_a_candidate", "S1-9")}


def test_reader(spark, tmp_path):
    p = tmp_path / "source1.tsv"
    p.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-00001\tNA\t12 \"Willow\tUS\nS1-00002\tNone\t\tIndia\n")
    rows = tsv.load_source(spark, str(p)).collect()
    assert [(r.business_name, r.business_address) for r in rows] == [("NA", '12 "Willow'), ("None", "")]
    assert tsv.find_source(spark, str(tmp_path), 1).endswith("source1.tsv") and tsv.find_source(spark, str(tmp_path), 2) is None
    p.write_text(p.read_text() + "S1-00003\tB\textra\ttab\tIndia\n")
    with pytest.raises(tsv.SanityCheckError, match="field count"):
        tsv.load_source(spark, str(p))
    assert tsv.check_source(spark, str(p), raise_on_failure=False)["n_bad"] == 1
    g = tmp_path / "ground_truth.tsv"
    g.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-1\nS1-2\t\n")
    spine, pairs = tsv.read_ground_truth(spark, str(g))
    assert spine.count() == 2 and {tuple(r) for r in pairs.collect()} == {("S1-1", "S2-1"), ("S1-1", "S3-1")}
    assert [r.frag_id for r in tsv.unknown_truth_ids(pairs, spark.createDataFrame([("S2-1",)], "frag_id string")).collect()] == ["S3-1"]
    g.write_text("a\tb\nS1-1\tS2-1\nS1-1\tS2-2\n")
    assert tsv.read_ground_truth(spark, str(g))[1].count() == 2


def test_namespace(spark):
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "entity_id string")
    got = {tuple(r) for r in audit.namespace({"S1": ids("S1-1", "S1-1"), "S2": ids("S1-1", "S2-1")}).collect()}
    assert got == {("wrong_prefix", "S2", "S1-1"), ("repeated", "S1", "S1-1"), ("shared", "S1", "S1-1")}


def test_proxy_and_run(spark):
    p = proxy.generate(spark, proxy.ProxyConfig(n_entities=60))
    q = proxy.generate(spark, proxy.ProxyConfig(n_entities=60))
    assert p.frames["S2"].exceptAll(q.frames["S2"]).count() == 0
    train, test = proxy.split_train_test(p)
    assert train.frames["S1"].filter("country = 'France'").count() == 0 and test.frames["S1"].filter("country = 'France'").count() > 0
    fr = p.frames["S2"].union(p.frames["S3"])
    linked = linkage.block(p.frames["S1"], fr)
    spine = p.frames["S1"].select(F.col("entity_id").alias("s1_id"))
    assert reports.completeness(p.truth, linked.fused).first().pair_completeness > 0.9
    predicted = linkage.predict(linked).persist()
    assert predicted.count() == predicted.select("frag_id").distinct().count()
    assert predicted.join(linked.fused, ["frag_id", "s1_id"], "left_anti").count() == 0
    assert score.macro_f(score.entity_scores(spine, p.truth, predicted)).first().n == 60
    s1, some = proxy.sample(p.frames["S1"], fr, p.truth, 10)
    assert s1.count() == 10 and some.count() == some.select("entity_id").distinct().count()
    streamed = chunks.chunked_hits(p.frames["S1"], fr.limit(20), 2)
    assert streamed.select("frag_id").distinct().count() > 0


def test_command_line_runs(spark, tmp_path):
    from kinmesh.plans import run

    p = proxy.generate(spark, proxy.ProxyConfig(n_entities=40))
    for n in (1, 2, 3):
        tsv.write_source(p.frames[f"S{n}"], str(tmp_path / f"source{n}.tsv"))
    lists = tsv.submission_rows(p.frames["S1"].select(F.col("entity_id").alias("s1_id")), p.truth)
    lists.coalesce(1).write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(str(tmp_path / "a_ground_truth.tsv"))
    found = run.audit_folder(spark, str(tmp_path))
    assert sum(r["n"] for r in found["scale"]) > 60 and found["namespace"] == 0 and found["unknown_truth_ids"] == 0
    report = run.link(spark, str(tmp_path), str(tmp_path / "out"), str(tmp_path / "model"), model_params={"maxIter": 3})
    assert report["violations"] == 0 and report["all"][0]["n"] == 40


def test_proxy_build_and_files(spark, tmp_path):
    made = proxy.build(spark, f"{tmp_path}/dataset", proxy.ProxyConfig(n_entities=40))
    assert tsv.find_root(spark, f"{tmp_path}/none", str(tmp_path)) == f"{tmp_path}/dataset" and set(made) == {"train", "test"}
    truth = f"{made['train']}/ground_truth.tsv"
    shape = tsv.ground_truth_shape(spark, truth)
    spine, pairs = tsv.read_ground_truth(spark, truth)
    assert shape == {"header": ["source1_entity_id", "matched_entity_ids"], "n_rows": spine.count()}
    row = audit.truth_shape(pairs.groupBy("s1_id").agg(F.count("*").alias("n"))).first()
    assert row.lists and row.n_masters == spine.count() and row.mean_t * row.n_masters == pytest.approx(pairs.count(), abs=0.01)
    ids = tsv.read_ids(spark, f"{made['train']}/source1.tsv")
    assert ids.count() == tsv.load_source(spark, f"{made['train']}/source1.tsv").count()
    assert tsv.submission_problems(spark, truth) == [] and len(tsv.submission_problems(spark, truth, "candidate_entity_ids", final=True)) == 2
    assert tsv.submission_problems(spark, f"{tmp_path}/no.tsv")[0].startswith("missing")
    (tmp_path / "blank.tsv").write_text("")
    assert tsv.submission_problems(spark, f"{tmp_path}/blank.tsv")[0].startswith("empty")
    with pytest.raises(tsv.SanityCheckError):
        tsv.read_submission(spark, f"{made['train']}/source1.tsv")
    assert reports.projection(36.0, 10, 10, 100, 100) == pytest.approx({"seconds_per_pair": 0.36, "hours_by_pairs": 1.0, "hours_by_fragments": 0.1})


def test_line_numbers_of_bad_lines(spark, tmp_path):
    head, good = "\t".join(tsv.SOURCE), "S1-1\tA\tB\tUS"
    (tmp_path / "s1.tsv").write_text("\n".join([head, good, "x\ty", good, "", good]) + "\n")
    report = tsv.check_source(spark, f"{tmp_path}/s1.tsv", raise_on_failure=False)
    assert (report["problem"], report["n_lines"], report["n_bad"], report["examples"]) == ("field count", 5, 2, [(3, "x\ty"), (5, "")])
    (tmp_path / "s2.tsv").write_text("\n".join([head, good, head, good]))
    report = tsv.check_source(spark, f"{tmp_path}/s2.tsv", raise_on_failure=False)
    assert (report["problem"], report["n_lines"], report["n_headers"]) == ("row count", 3, 1)
    (tmp_path / "s3.tsv").write_text("\r\n".join([head, good, good]) + "\r\n")
    assert tsv.check_source(spark, f"{tmp_path}/s3.tsv")["ok"]
