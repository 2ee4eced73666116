import random
import zlib
from collections import Counter

import numpy as np

from histora.llm.binary_output import Capacities, best_fit_decreasing, packed_output, segments, write_packed
from histora.llm.tokens import tokenizer, tokenizer_path
from tests.llm.test_packing import plain_best_fit


def test_the_tree_finds_the_smallest_sufficient_capacity():
    rng = random.Random(0)
    tree, held = Capacities(100), Counter()
    for _ in range(5000):
        if rng.random() < 0.55:
            free = rng.randint(1, 100)
            tree.put(free, free)
            held[free] += 1
        else:
            size = rng.randint(1, 100)
            want = min((f for f, n in held.items() if n and f >= size), default=None)
            got = tree.take(size)
            assert (got and got[0]) == want
            if got:
                held[want] -= 1


def test_packing_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randint(1, 64) for _ in range(rng.randint(0, 200))]
        found = best_fit_decreasing(sizes, 64)
        assert len(found) == plain_best_fit(sizes, 64)
        assert sorted(i for x in found for i in x) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in x) <= 64 for x in found)


def round_trip(df, path, **options):
    """The written matrices hold exactly the ids of the documents."""
    packed = write_packed(df, path, **options).collect()
    capacity = options.get("capacity", 2048)
    pieces = {}
    for r in packed:
        ids = np.frombuffer(r.ids, "<u2")
        marks = np.flatnonzero(np.unpackbits(np.frombuffer(r.resets, np.uint8), bitorder="little")).tolist()
        assert len(ids) == capacity and marks == r.cu_seqlens[:-1] and r.cu_seqlens[0] == 0
        assert not ids[r.cu_seqlens[-1] :].any()
        for name, piece, start, a, b in zip(r.doc_ids, r.pieces, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            pieces.setdefault((name, piece, start), []).append(ids[a:b].tolist())
    coder = tokenizer(tokenizer_path())
    want = {}
    for r in df.collect():
        ids = [*np.frombuffer(coder.encode([r.text or ""])[0], "<u4").tolist(), 0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            want.setdefault((r.doc_id, k, at), []).append(ids[at : at + capacity])
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    return packed


def test_round_trip(documents, tmp_path):
    packed = round_trip(documents, str(tmp_path / "a"))
    tokens = sum(r.cu_seqlens[-1] for r in packed)
    assert len(packed) <= -(-tokens // 2048) + 2
    many = round_trip(documents, str(tmp_path / "b"), capacity=256, shard_tokens=5000)
    assert len({r.shard for r in many}) > 5


def test_segments_are_read_from_the_binary_columns(documents, tmp_path):
    packed = write_packed(documents, str(tmp_path / "a"), 512)
    rows = segments(packed).collect()
    assert sum(r.length for r in rows) == sum(r.cu_seqlens[-1] for r in packed.collect())
    by = {(r.shard, r.sequence): r for r in packed.collect()}
    for r in rows:
        ids = np.frombuffer(by[r.shard, r.sequence].ids, "<u2")[r.offset : r.offset + r.length]
        assert zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32
        assert r.position_resets == len(by[r.shard, r.sequence].doc_ids)


def test_odd_rows(odd_rows, tmp_path):
    round_trip(odd_rows, str(tmp_path / "a"))
    assert packed_output(odd_rows.limit(0)).collect() == []
