"""Abuse that is rare among many toxic texts is learned."""

import random

from kinmesh.llm import toxicity


def test_rare_terms(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    rows = []
    for i in range(6000):
        bad = i % 2 == 0
        w = [word() for _ in range(12)]
        if bad:
            w.insert(rnd.randint(0, 12), "oafling" if i < 40 else "qwretch")  # 20 of 3,000: below 0.4 %, G about 28
        rows.append((str(i), " " + " ".join(w) + " ", bad))
    train = spark.createDataFrame(rows, "doc_id string, text string, toxic boolean")
    terms = toxicity.learn_terms(train, 3000, 3000)
    assert any(t.startswith(" qwre") for t in terms) and any(t.startswith(" oaf") for t in terms)


def test_many_neighbours_are_not_asked(spark):
    rows = [(str(i), f" {'abcd'[i % 4] * 4} zounder " if i % 2 else f" w{i % 97} said ", i % 2 == 1) for i in range(4000)]
    rows += [(f"x{i}", f" {'efgh'[i % 4] * 4} zounder ", True) for i in range(40)]
    train = spark.createDataFrame(rows, "doc_id string, text string, toxic boolean")
    assert " zounder " in toxicity.learn_terms(train, 2040, 2000)  # six words before it, in 2,040 texts
