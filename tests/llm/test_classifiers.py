import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from histora.llm import quality as fm
from histora.llm import toxicity as kn


def held_out(n):
    return n is None or zlib.crc32(str(n).encode()) % 5 == 0


def good_and_bad(spark, n=600):
    rng = random.Random(1)
    words = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(40, 120))]
        bad = i % 4 == 0
        if bad:
            text = [w.upper() + "!!" for w in text] if i % 8 else [text[0]] * 30 + [text[1]] * 30
        rows.append((i, " ".join(text)))
        labels.append((i, int(not bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality_of_held_out_rows(spark):
    docs, labels = good_and_bad(spark)
    rows = fm.quality_scores(docs, labels).join(labels, "doc_id").collect()
    assert len(rows) == 600 and all(r.held_out == held_out(r.doc_id) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in unseen) >= 0.97 * len(unseen)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = good_and_bad(spark, 200)
    wrong = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    a = {r.doc_id: r.score for r in fm.quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in fm.quality_scores(docs, labels.withColumn("quality", wrong)).collect()}
    assert a == b


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    model = [0.3, rng.normal(size=50), rng.normal(size=(50, 4))]
    index, value = np.array([3, 7, 7, 20]), np.array([0.5, 1.0, 2.0, -1.0])
    pairs = sum(value[i] * value[j] * model[2][index[i]] @ model[2][index[j]] for i in range(4) for j in range(i))
    want = 0.3 + (model[1][index] * value).sum() + pairs
    assert abs(fm.forward(model, index, value, np.array([0]))[0][0] - want) < 1e-9


def test_gradient_of_the_machine():
    """One Adagrad step from a known start moves every weight against its numerical derivative."""
    rng = np.random.default_rng(3)
    model = [0.1, rng.normal(size=12), rng.normal(size=(12, 3))]
    index, value, y = np.array([1, 5, 9]), np.array([0.4, 1.0, 0.7]), 1.0

    def loss(m):
        z = fm.forward(m, index, value, np.array([0]))[0][0]
        return math.log(1 + math.exp(-z)) * y + math.log(1 + math.exp(z)) * (1 - y)

    z, sums, x = fm.forward(model, index, value, np.array([0]))
    error = 1 / (1 + math.exp(-z[0])) - y
    grad = error * value[:, None] * (np.repeat(sums, 3, axis=0) - x)
    for i in range(3):
        for f in range(3):
            up, down = [model[0], model[1], model[2].copy()], [model[0], model[1], model[2].copy()]
            up[2][index[i], f] += 1e-6
            down[2][index[i], f] -= 1e-6
            assert abs((loss(up) - loss(down)) / 2e-6 - grad[i, f]) < 1e-5


def toxic_rows(spark, n=500):
    rng = random.Random(4)
    words = ["".join(rng.choices("aeioulmnrst", k=rng.randint(3, 7))) for _ in range(300)]
    insults = ["vilxon", "gruzzak", "zogbim"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(30, 150))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(1 + len(text) // 40):
                text[rng.randrange(len(text))] = rng.choice(insults) + rng.choice(["", "ra", "tel", "mo"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_of_held_out_rows(spark):
    docs, labels = toxic_rows(spark)
    rows = kn.toxicity_scores(docs, labels).join(labels, "doc_id").collect()
    assert len(rows) == 500 and all(r.held_out == held_out(r.doc_id) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.toxic for r in unseen) >= 0.95 * len(unseen)


def test_kneser_ney_sums_to_one():
    """Against a plain recursion; P over the letters seen in a context, and the mass left, make 1."""
    from collections import Counter, defaultdict

    grams = Counter(g for w in ["stone", "store", "tone", "note", "stone"] for g in kn.grams_of(w))
    names = list(grams)
    p = dict(zip(names, kn.lower_order(names, list(grams.values())), strict=True))
    by = defaultdict(list)
    for g in names:
        by[g[:-1]].append(g)
    for h, held in by.items():
        total = sum(grams[g] for g in held)
        left = kn.DISCOUNT * len(held) / total
        own = sum((grams[g] - kn.DISCOUNT) / total for g in held)
        assert abs(own + left - 1) < 1e-9
        lower = {g: (p[g] - (grams[g] - kn.DISCOUNT) / total) / left for g in held}
        assert all(0 < x <= 1 for x in lower.values()) and sum(lower.values()) <= 1 + 1e-9


def test_what_no_class_has_seen_is_judged_by_the_mass_left_only():
    m = kn.Model(["aaaab", "aaaac"], [0.5, 0.5], [np.array([3, 1]), np.array([1, 3])])
    assert m.ratio("qqqq") == 0.0
    assert m.grams["aaaac"] > 0 > m.grams["aaaab"]


@pytest.mark.parametrize("scores, label", [(fm.quality_scores, "quality"), (kn.toxicity_scores, "toxic")])
def test_odd_rows(spark, odd_rows, scores, label):
    labels = [(i, i % 2) for i in range(8)] + [(3, None), (None, 1), (99, 1)]
    labels = spark.createDataFrame(labels, f"doc_id long, {label} int")
    rows = scores(odd_rows, labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r.score)
    assert by[0] == by[1] and len(by[4]) == 2 and by[4][0] == by[4][1] == by[5][0]
    assert all(r.held_out == held_out(r.doc_id) for r in rows)
    assert scores(odd_rows.limit(0), labels).collect() == []
    assert scores(odd_rows, labels.limit(0)).count() == 10
