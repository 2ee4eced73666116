import random

import numpy as np
import pytest

from histora.llm.decontaminate import GAP, MATCH, MISMATCH, align, contaminated, plain_words


def plain_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = MATCH if a[i - 1] == b[j - 1] else MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] - GAP, h[i, j - 1] - GAP)
    return int(h.max())


@pytest.mark.parametrize("seed", range(30))
def test_alignment_equals_the_plain_recursion(seed):
    rng = random.Random(seed)
    a = [rng.randrange(4) for _ in range(rng.randint(1, 25))]
    b = [rng.randrange(4) for _ in range(rng.randint(1, 40))]
    score, start, end = align(np.array(a, np.uint64), np.array(b, np.uint64))
    assert score == plain_align(a, b)
    assert plain_align(a, b[start:end]) == score


def passages(rng, n=30):
    return [(i, " ".join(f"v{rng.randrange(3000)}" for _ in range(rng.randint(20, 60)))) for i in range(n)]


def changed(text, share, rng):
    out = []
    for w in text.split():
        x = rng.random()
        out += [] if x < share / 3 else [f"n{rng.random()}"] if x < 2 * share / 3 else [w, f"i{rng.random()}"] if x < share else [w]
    return " ".join(out)


def test_verbatim_and_edited_copies_are_found_and_others_left(spark):
    rng = random.Random(9)
    items = passages(rng)
    docs, want = [], set()
    for i in range(300):
        fill = [" ".join(f"v{rng.randrange(3000)}" for _ in range(rng.randint(0, 200))) for _ in range(2)]
        inside = ""
        if i % 3 == 0:
            item = rng.choice(items)
            inside = changed(item[1], rng.choice([0, 0, 0.1, 0.2]), rng).upper()
            want.add((i, item[0]))
        elif i % 3 == 1:  # a small part of an item is no copy
            inside = " ".join(rng.choice(items)[1].split()[:6])
        docs.append((i, f"{fill[0]} {inside}. {fill[1]}"))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for options in ({}, {"block_words": 200}):
        got = contaminated(df, bench, **options).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
        assert all(0.5 <= r.score <= 1 and r.first_word < r.last_word for r in got)


def test_every_pair_on_the_test_tables(spark, folder, documents):
    """Against aligning every document with every item."""
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.score for r in contaminated(documents, bench).collect()}
    items = [(r.item_id, plain_words(r.text)) for r in bench.collect()]
    want = {}
    for r in documents.limit(60).collect() + [r for r in documents.collect() if any(k[0] == r.doc_id for k in got)]:
        words = plain_words(r.text)
        for i, item in items:
            score = align(item, words)[0] / (MATCH * len(item))
            if score >= 0.5:
                want[r.doc_id, i] = score
    assert {k: v for k, v in got.items() if k in want} == want and len(want) == len(got)


def test_a_passage_in_every_document_is_still_found(spark):
    rng = random.Random(3)
    items = passages(rng, 2)
    docs = [(i, f"a{i} b{i} c{i} {items[0][1]} d{i}") for i in range(100)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in contaminated(df, bench).collect()} == {(i, 0) for i in range(100)}


def test_odd_rows(spark, odd_rows):
    schema = "item_id long, text string, score double, doc_id long"
    items = [(1, "same short text of", 0.1, 5), (1, "same short text of", 0.1, 5), (2, None, None, None), (3, " ", None, 1), (None, "one", 1.0, 1)]
    got = [(r.doc_id, r.item_id, r.score) for r in contaminated(odd_rows, spark.createDataFrame(items, schema)).collect()]
    assert sorted(got) == [(4, 1, 1.0), (4, 1, 1.0), (5, 1, 1.0)]
    items = spark.createDataFrame([(7, "without an id", 0.0, 0)], schema)
    assert [(r.doc_id, r.item_id) for r in contaminated(odd_rows, items).collect()] == [(None, 7)]
    assert contaminated(odd_rows.limit(0), items).collect() == []
    assert contaminated(odd_rows, items.limit(0)).collect() == []


def test_short_items_and_scripts_without_blanks(spark):
    items = [(1, "Quantum entanglement"), (2, "photosynthesis"), (3, "天地玄黄宇宙洪荒日月盈昃"), (4, "ภาษาไทยไม่มีช่องว่าง"), (5, "three words here")]
    docs = [
        (1, "They spoke of quantum entanglement, and more."),
        (2, "quantum of entanglement"),
        (3, "On (photosynthesis)!"),
        (4, "千字文：天地玄黄，宇宙洪荒，日月盈昃。辰宿列张"),
        (5, "地天黄玄宙宇荒洪月日昃盈"),
        (6, "ดีมาก ภาษาไทยไม่มีช่องว่าง ครับ"),
        (7, "entanglement"),
        (8, "Quantum entanglement"),
        (9, "of three words here and there"),
        (10, "three other words"),
    ]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for options in ({}, {"block_words": 1}):
        got = {(r.doc_id, r.item_id) for r in contaminated(df, bench, **options).collect()}
        assert got == {(1, 1), (3, 2), (4, 3), (6, 4), (8, 1), (9, 5)}
