import itertools
import random

import numpy as np

from histora.llm.components import components
from histora.llm.neardup import fewest_equal, near_duplicates, shingle_set, signature, hash_functions


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(docs, percent=75):
    """Component (smallest id) by comparing all pairs."""
    sets = [(n, shingles(t)) for n, t in docs]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (n, _) in enumerate(sets):
        least[find(i)] = min((x for x in (least.get(find(i)), n) if x is not None), default=None)
    return {(n, len(s), least[find(i)]) for i, (n, s) in enumerate(sets)}


def check(df):
    rows = near_duplicates(df).collect()
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert len(rows) == len(docs)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in rows} == brute(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_documents(documents):
    check(documents)


def edited(words, share, rng):
    return " ".join(f"x{rng.random()}" if rng.random() < share else w for w in words)


def test_a_crowd_of_copies_and_a_shared_passage(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    passage = [f"p{i}" for i in range(60)]
    texts = [edited(base, rng.choice([0.0, 0.01, 0.02, 0.04, 0.08]), rng) for _ in range(250)]
    texts += [" ".join([*(f"y{rng.random()}" for _ in range(rng.randint(5, 60))), *passage]) for _ in range(200)]
    texts += [" ".join(base)] * 100
    rng.shuffle(texts)
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_a_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i * 10 : i * 10 + 100]) for i in range(30)]
    df = spark.createDataFrame([(100 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    check(df)
    assert {r.component_id for r in near_duplicates(df).collect()} == {71}


def test_the_boundary_counts(spark):
    # 8 shingles, 6 of them shared by both: 6 of 8 is 75 of 100
    a = "a b c d e f g h i j"
    df = spark.createDataFrame([(1, a), (2, "a b c d e f g h i j k l"), (3, "a b c d e f g h i j k l m")], "doc_id long, text string")
    check(df)


def test_odd_rows(odd_rows):
    rows = near_duplicates(odd_rows).collect()
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows}
    assert {(0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 2, 4, True), (5, 2, 4, False)} <= got
    assert {(6, 5996, 6, True), (7, 5997, 6, False), (None, 1, None, True)} <= got
    assert len(rows) == 10 and sum(r.doc_id == 4 for r in rows) == 2


def test_empty_table(odd_rows):
    assert near_duplicates(odd_rows.limit(0)).collect() == []


def test_only_texts_without_words(spark):
    rows = near_duplicates(spark.createDataFrame([(1, ""), (2, None), (3, " ")], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in rows} == {(1, 1, True), (2, 2, True), (3, 3, True)}


def test_signatures_agree_as_often_as_sets_overlap():
    factors, terms = hash_functions(4096)
    a = shingle_set(" ".join(f"w{i}" for i in range(300)))
    b = shingle_set(" ".join(f"w{i}" for i in range(60, 360)))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signature(a, factors, terms) == signature(b, factors, terms)).mean() - true) < 0.03


def test_posterior_bound_by_integration():
    t, miss = 0.75, 1e-4
    x = (np.arange(200_000) + 0.5) / 200_000
    for n in (32, 64, 128):
        for m in (fewest_equal(n, t, miss) - 1, fewest_equal(n, t, miss)):
            log = m * np.log(x) + (n - m) * np.log(1 - x)
            p = np.exp(log - log.max())
            assert (p[x >= t].sum() / p.sum() >= miss) == (m >= fewest_equal(n, t, miss))


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {i: i for i in range(300)}
    for _ in range(300):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert found == {i: r for i, r in root.items() if i != r}
