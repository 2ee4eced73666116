import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from histora.llm.sharding import KEY_BITS, minimax_cuts, shard_by_bytes


def need(weights, capacity):
    n, at = 1, 0
    for w in weights:
        if w > capacity:
            return 1 << 60
        if at + w > capacity:
            n, at = n + 1, 0
        at += w
    return n


def brute_capacity(weights, shards):
    low, high = 0, sum(weights)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if need(weights, middle) <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("seed", range(12))
def test_search_over_ranges_is_exact(seed):
    random.seed(seed)
    crowd = seed % 3 == 0  # keys in one corner, so that ranges have to be refined often
    bits = 30 if crowd else KEY_BITS
    groups = {random.getrandbits(bits): random.choice([1, 5, 40, 900 if seed % 2 else 7]) for _ in range(3000)}
    calls = []

    def fetch(shift, parents, parent_shift):
        held = defaultdict(list)
        for k, w in groups.items():
            if parents is None or k >> parent_shift in set(parents):
                held[k >> shift].append(w)
        calls.append(len(held))
        return [(p, sum(w), max(w), len(w)) for p, w in held.items()]

    found = minimax_cuts(fetch, 16)
    order = sorted(groups)
    sums = [sum(groups[k] for k in order if a <= k < b) for a, b in zip([0, *found], [*found, 1 << KEY_BITS], strict=True)]
    assert len(sums) <= 16
    assert max(sums) == brute_capacity([groups[k] for k in order], 16)
    assert len(calls) <= 8


def check(rows, docs, shards=16):
    texts = defaultdict(list)
    for name, text in docs:
        texts[name].append(text or "")
    expected = Counter((n, len(t.encode()) + 1, zlib.crc32(t.encode())) for n, ts in texts.items() for t in ts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    slots, places = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        places[r["size"], r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(p) == 1 for p in places.values())
    assert set(slots) <= set(range(shards))
    assert {r.law for r in rows} <= {"bytes"} and {r.grown_shard for r in rows} <= {None}


def test_documents(documents):
    rows = shard_by_bytes(documents).collect()
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    check(rows, docs)
    size = Counter()
    for _, t in docs:
        size[int(hashlib.md5(t.encode()).hexdigest()[:15], 16)] += len(t.encode()) + 1
    left, total, weights = 16, sum(size.values()), []
    big = sorted(size, key=lambda k: (-size[k], k))
    while left > 1 and size[big[0]] * left > total:
        total, left = total - size[big[0]], left - 1
        del size[big.pop(0)]
    weights = [size[k] for k in sorted(size)]
    sums = Counter()
    for r in rows:
        sums[r.shard] += r["size"]
    assert max(s for i, s in sums.items() if i >= 16 - left) == brute_capacity(weights, left)


def test_a_group_larger_than_a_share_gets_a_shard_of_its_own(spark):
    rows = [(i, "copy " * 200) for i in range(200)] + [(1000 + i, f"text {i} " * 30) for i in range(400)]
    found = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    check(found, rows, 8)
    sums = Counter()
    for r in found:
        sums[r.shard] += r["size"]
    rest = [s for i, s in sums.items() if i != 0]
    assert sums[0] == 200 * 1001 and max(rest) < 1.1 * min(rest)


def test_odd_rows(odd_rows):
    check(shard_by_bytes(odd_rows).collect(), [(r.doc_id, r.text) for r in odd_rows.collect()])


def test_empty_table(odd_rows):
    assert shard_by_bytes(odd_rows.limit(0)).collect() == []
