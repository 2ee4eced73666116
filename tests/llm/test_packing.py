import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from histora.llm.packing import best_fit, pack, pack_documents, plan, reduce_by_dominance
from histora.llm.tokens import TextTokenizer, tokenizer_path


def fewest(sizes, capacity):
    """The least number of sequences, by trying all ways."""
    best = [len(sizes)]

    def put(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                put(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        put(i + 1, [*rooms, capacity - sizes[i]])

    put(0, [])
    return best[0]


def plain_best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fit = [r for r in rooms if r >= s]
        if fit:
            rooms[rooms.index(min(fit))] -= s
        else:
            rooms.append(capacity - s)
    return len(rooms)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_dominance_keeps_the_optimum(sizes):
    fixed, left = reduce_by_dominance(dict(Counter(sizes)), 20)
    rest = [s for s, n in left.items() for _ in range(n)]
    assert sum(n for _, n in fixed) + (fewest(rest, 20) if rest else 0) == (fewest(sizes, 20) if sizes else 0)
    used = Counter(rest)
    for content, n in fixed:
        assert sum(s * k for s, k in content) <= 20
        for s, k in content:
            used[s] += k * n
    assert used == Counter(sizes)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_best_fit_on_counts_is_best_fit(sizes):
    found = best_fit(dict(Counter(sizes)), 30)
    assert sum(n for _, n in found) == plain_best_fit(sizes, 30)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=25))
def test_plan_places_every_piece_once(pieces):
    runs, sequences = plan(pieces, 50)
    places = defaultdict(list)
    numbers = defaultdict(list)
    for r in runs:
        for k in range(r.count * r.copies):
            numbers[r.length].append(r.first + k)
            places[r.sequence + k // r.copies].append((r.offset + k % r.copies * r.length, r.length))
    assert {s: sorted(n) for s, n in numbers.items()} == {s: list(range(n)) for s, n in pieces.items()}
    assert len(places) == sequences
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 50


def test_both_libraries_give_the_same_ids():
    coder = TextTokenizer(tokenizer_path())
    random.seed(3)
    letters = ["a", "Bc", "é", "ß", " ", "  ", "\n", "\t", "'s", "12", ".", "!!", "中文", "😀", " ", "　", "<|endoftext|>", "ж"]
    texts = ["", " ", *("".join(random.choices(letters, k=random.randint(1, 40))) for _ in range(3000))]
    assert coder.ids(texts) == coder.encode(texts)


def test_both_libraries_agree_on_every_latin_letter():
    coder = TextTokenizer(tokenizer_path())
    forms = ("a {}b c", "a b{} c", "a b{}c d", "a {}1 b", "a ,{}. b", "x {}{} y", "x 1{}2 y", "x .{}{}' y")
    texts = [f.replace("{}", chr(c)) for c in range(1, 0x250) for f in forms]
    assert coder.ids(texts) == coder.encode(texts)


def check_places(rows, docs, capacity=2048):
    """Every document whole, sequences gapless from 0."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    expected = Counter()
    for name, text in docs:
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        first = len(ids) % capacity or min(capacity, len(ids))
        ends = [first, *range(first + capacity, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
            expected[name, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    return len(held)


def test_documents_are_packed_whole_and_tight(documents):
    rows = pack_documents(documents).collect()
    used = check_places(rows, [(r.doc_id, r.text) for r in documents.collect()])
    assert used <= -(-sum(r.length for r in rows) // 2048) + 1


def test_odd_rows(odd_rows):
    check_places(pack_documents(odd_rows).collect(), [(r.doc_id, r.text) for r in odd_rows.collect()])


def test_empty_table(odd_rows):
    assert pack_documents(odd_rows.limit(0)).collect() == []


def test_a_frequent_length_and_repeated_keys(spark):
    pieces = spark.createDataFrame([(1, 0, 7)] * 500 + [(i, 0, 3) for i in range(100)], "doc_id long, piece int, length long")
    rows = pack(pieces, ["doc_id", "piece"], 10).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 600
    assert len({r.sequence_id for r in rows}) == 500


def test_too_long_a_piece_is_refused(spark):
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(1, 11)], "k long, length long"), ["k"], 10)
