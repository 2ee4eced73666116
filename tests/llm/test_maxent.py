import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

import pytest

from histora.llm import maxent as me
from histora.llm.common import ascii_words


def tokens(text):
    return [*(text or "").encode().lower().split(), me.END]


def brute(docs):
    """held out, tokens, known, total and base score of each row."""
    out = lambda n: n is None or zlib.crc32(str(n).encode()) % 7 == 2
    c = Counter(w for n, t in docs if not out(n) for w in tokens(t))
    total = sum(c.values())
    for n, t in docs:
        w = tokens(t)
        yield n, out(n), len(w), sum(c[x] > 0 for x in w), total, sum(math.log10((c[x] + 1) / (total + len(c) + 1)) for x in w)


def check(df):
    docs = [(r.doc_id, r.text) for r in df.collect()]
    rows = me.maxent_scores(df).collect()
    want = sorted(brute(docs), key=lambda x: (str(x[0]), x[2], x[5]))
    got = sorted(rows, key=lambda r: (str(r.doc_id), r.n_tokens, r.base_score))
    assert len(got) == len(want)
    for r, w in zip(got, want, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:5]
        assert abs(r.base_score - w[5]) < 1e-6 and r.score <= 0 and math.isfinite(r.score)
    return rows


def test_documents(documents):
    rows = check(documents)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_of_one_place_sum_to_one():
    """Over all words of the vocabulary, the end, and the rare words with the unseen one."""
    rng = np.random.default_rng(0)
    counts = np.sort(rng.integers(2, 500, 900))[::-1].copy()
    rare = [3, 1, 1, 1]
    voc = me.Vocabulary(rng.integers(-(1 << 62), 1 << 62, 900), rng.integers(0, 6, 900).astype(np.int32), counts, 40, int(counts.sum()) + 46, 6, 3)
    weights = rng.normal(size=(me.ROWS, me.CLASSES)).astype(np.float32)
    weights[0] += voc.start
    _, _, rows = me.features(voc, [np.array([5, 7, 800])])
    for z in me.exponentials(weights, rows).astype(float):
        z /= z.sum()
        known = sum(z[voc.classes[c]] * math.exp(voc.share[c]) for c in range(901))
        others = z[me.RARE] * (sum(rare) + voc.unseen) / voc.rare_total
        assert abs(known + others - 1) < 1e-4


def forks_of(n=900):
    rng = np.random.default_rng(2)
    classes = np.sort(rng.integers(0, 20, n))
    counts = rng.integers(1, 500, n)
    return rng, classes, counts, me.Forks(classes, counts, n + 6)


def test_words_of_a_class_start_at_their_shares_and_sum_to_one():
    rng, classes, counts, forks = forks_of()
    shares = counts / np.bincount(classes, weights=counts)[classes]
    before = me.contexts(np.array([5, 7, 8]), np.array([0]))[:, 2:].repeat(900, axis=1)
    codes = np.arange(900)
    assert np.allclose(forks.log_probability(np.zeros(forks.slots, np.float32), codes, before), np.log(shares), atol=1e-4)
    p = np.exp(forks.log_probability(rng.normal(size=forks.slots).astype(np.float32), codes, before))
    assert np.allclose(np.bincount(classes, weights=p), 1) and not np.allclose(p, shares, atol=0.01)
    assert (forks.log_probability(np.zeros(forks.slots, np.float32), np.array([900, 905]), before[:, :2]) == 0).all()


def test_a_step_at_the_forks_goes_down_the_gradient():
    rng, _, _, forks = forks_of()
    codes = np.tile([3, 700, 451, 20], 200)
    before = me.contexts(codes, np.array([0]))
    weights, squares, sums = np.zeros(forks.slots, np.float32), np.ones(forks.slots, np.float32), np.zeros(forks.slots, np.float32)
    loss = lambda: -forks.log_probability(weights, codes, before).mean()
    losses = [loss()]
    for _ in range(30):
        forks.descend(weights, squares, sums, codes, before)
        losses.append(loss())
    assert losses[1] < losses[0] and losses[-1] < 0.1 * losses[0] and not sums.any()


def test_words_of_one_class_are_told_apart_by_the_words_before(spark):
    """Phrases of words that share classes: the usual partner scores higher than another word of its class."""
    pairs = [(f"first{i:03d}xx", f"second{i:03d}xx") for i in range(60)]
    rng = np.random.default_rng(4)
    say = lambda p: " ".join(f"{a} {b}" for a, b in p)
    rows = [(i, say([pairs[j] for j in rng.integers(0, 60, 80)])) for i in range(400)]
    swapped = [(a, pairs[(i + 1) % 60][1]) for i, (a, _) in enumerate(pairs)]
    df = spark.createDataFrame([*rows, (1000, say(pairs)), (1001, say(swapped))], "doc_id long, text string")
    by = {r.doc_id: r for r in me.maxent_scores(df).collect()}
    assert by[1000].score > by[1001].score + 30


def test_a_step_goes_down_the_gradient():
    rng = np.random.default_rng(1)
    n = 400
    rows = [rng.integers(1, 5, n), rng.integers(5, 9, n), rng.integers(9, 13, n)]
    classes = (rows[0] + rows[1]) % me.CLASSES
    weights, squares = np.zeros((me.ROWS, me.CLASSES), np.float32), np.ones(me.ROWS, np.float32)
    loss = lambda: -me.log_probability(weights, rows, classes).mean()
    losses, seen = [loss()], np.zeros(me.ROWS)
    for _ in range(30):
        me.descend(weights, squares, seen, rows, classes)
        losses.append(loss())
    assert losses[-1] < 0.5 * losses[0] and losses[1] < losses[0]
    assert seen[0] == 30 * n and seen[1:5].sum() == 30 * n


def test_what_follows_what_is_learned(spark):
    rows = [(i, "red apple green pear " * 20 if i % 2 else "green apple red pear " * 20) for i in range(300)]
    df = spark.createDataFrame(rows + [(1000, "red apple green pear " * 5), (1001, "pear green apple red " * 5)], "doc_id long, text string")
    by = {r.doc_id: r for r in me.maxent_scores(df).collect()}
    assert by[1000].score > by[1001].score + 3
    assert sum(r.score for r in by.values()) > sum(r.base_score for r in by.values())


def test_a_small_vocabulary_joins_the_rest(documents):
    df = documents.limit(120)
    rows = {(r.doc_id): r for r in me.maxent_scores(df, vocabulary=50).collect()}
    for n, out, size, known, total, base in brute([(r.doc_id, r.text) for r in df.collect()]):
        r = rows[n]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, size, known, total)
        assert abs(r.base_score - base) < 1e-6


def test_odd_rows(odd_rows):
    rows = check(odd_rows)
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert me.maxent_scores(odd_rows.limit(0)).collect() == []
    alone = me.maxent_scores(odd_rows.where("doc_id is null")).collect()
    assert [(r.held_out, r.train_tokens, r.base_score) for r in alone] == [(True, 0, 0.0)]


def test_scores_do_not_depend_on_how_the_input_is_split(spark, documents, monkeypatch):
    monkeypatch.setattr(me, "TASK_TOKENS", 2_000)
    found, changes = [], []
    plain = me.train

    def counted(coded, *given):
        changes.append(given[-1])
        return plain(coded, *given)

    monkeypatch.setattr(me, "train", counted)
    for parts in (4, 64):
        rows = me.maxent_scores(documents.repartition(parts), vocabulary=2000).collect()
        found.append({r.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in rows})
    assert changes[0] == changes[1] > 1, "tasks of a round, each of which gives out one change"
    assert found[0].keys() == found[1].keys()
    for i, want in found[0].items():
        assert found[1][i] == pytest.approx(want, rel=1e-6)


def test_copies_of_one_row_are_dealt_to_several_tasks(spark):
    rows = [(1, "the same words again and again")] * 400 + [(i, f"word{i} other text") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scores = {r.doc_id: r.score for r in me.maxent_scores(docs).collect()}
    assert len(scores) == 39 and all(s < 0 for s in scores.values())


def words_of_the_model(n):
    """The words v0 to v(n - 1), the first ones most frequent, with the model of them."""
    names = [f"v{i}" for i in range(n)]
    hashes, groups = me.hashes_and_groups(pa.array(names, pa.string()))
    return names, me.Vocabulary(hashes, groups, np.arange(n + 2, 2, -1), 9, 9 + n * n, 40, 20)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("size", [0, 1, 50])
def test_codes_of_a_batch_are_those_of_its_words(kind, size):
    texts = [None, "", " V3 v0\tx \x0b", "\n", "v0 v0 rare rare other \x1c \x85 v49", "caf\u00e9 \u00c9 \u2003v1 rare", None, "y"]
    names, voc = words_of_the_model(size)
    codes, bounds, text, hashes, times = voc.encode(pa.array(["before", *texts, "behind"], kind).slice(1, len(texts)))
    assert len(bounds) == len(texts) + 1
    for i, t in enumerate(texts):
        words = ascii_words(t)
        rank = [names.index(w.decode()) if w.decode() in names else None for w in words]
        group = [zlib.crc32(w[-2:]) % me.GROUPS for w in words]
        assert codes[bounds[i] : bounds[i + 1]].tolist() == [size + 1 + g if r is None else 1 + r for r, g in zip(rank, group, strict=True)]
        rare = Counter(me.xxhash.xxh3_64_intdigest(w) - (1 << 63) for w, r in zip(words, rank, strict=True) if r is None)
        assert dict(zip(hashes[text == i].tolist(), times[text == i].tolist(), strict=True)) == rare


def test_a_word_is_hashed_once_in_a_batch(monkeypatch):
    _, voc = words_of_the_model(3)
    asked, plain = [], me.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(me.xxhash, "xxh3_64_intdigest", lambda w: asked.append(w) or plain(w))
    voc.encode(pa.array(["rare v1 rare v1", "rare", "v1 rare"] * 50))
    assert sorted(asked) == [b"rare", b"v1"]


def test_words_are_counted(spark):
    texts = [None, "", " ", "a b A", "B\x0bb\x1c", "a\n", "\u00c9t\u00e9 "]
    counted = me.count_words(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    want = Counter(w for t in texts for w in ascii_words(t))
    assert {(r.h, r.g, r.c) for r in counted} == {(me.xxhash.xxh3_64_intdigest(w) - (1 << 63), zlib.crc32(w[-2:]) % me.GROUPS, n) for w, n in want.items()}


def test_sums_of_runs_of_all_lengths():
    rng = np.random.default_rng(3)
    for sizes in (np.ones(40, int), np.arange(1, 12), rng.integers(1, 4 * me.SHORT, 200), np.array([900]), np.array([2])):
        values = rng.normal(size=(sizes.sum(), me.CLASSES)).astype(np.float32)
        first = np.cumsum(sizes) - sizes
        assert np.allclose(me.run_sums(values, first, sizes), np.add.reduceat(values, first, axis=0), atol=1e-4)


def test_steps_at_the_forks_are_those_of_separate_batches():
    """One call over many batches learns what one call for each batch does, and what the formulas say."""
    rng, _, _, forks = forks_of()
    codes = rng.integers(0, 900, 1000)
    before = me.contexts(codes, np.array([0, 300]))
    state = lambda: (np.zeros(forks.slots, np.float32), np.ones(forks.slots, np.float32), np.zeros(forks.slots, np.float32))
    whole, parts, plain = state(), state(), [x.astype(float) for x in state()]
    forks.descend(*whole, codes, before, batch=70)
    for b in range(0, 1000, 70):
        forks.descend(*parts, codes[b : b + 70], before[:, b : b + 70])
        _, side, z, slots = forks.places(codes[b : b + 70], before[:, b : b + 70])
        g = 1 / (1 + np.exp(-(z + plain[0][slots].sum(axis=0)))) - side
        change = np.bincount(slots.ravel(), weights=np.tile(g, 3), minlength=forks.slots)
        plain[1] += change**2
        plain[0] -= 0.2 * change / np.sqrt(plain[1])
    for x, y, z in zip(whole, parts, plain, strict=True):
        assert np.array_equal(x, y) and np.allclose(x, z, atol=1e-3)
    assert not whole[2].any() and whole[0].any()
