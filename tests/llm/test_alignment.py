"""Alignment of two tokenizers against a token by token walk."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from histora.llm import alignment as al
from histora.llm.tokens import tokenizer_path


@pytest.fixture(scope="module")
def both():
    return al.tokenizer_pair(tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def plain():
    """The same ids straight from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def walk(text, plain, both):
    """(a ids, b ids, groups, links) of one text, found by walking along the bytes."""
    if not text:
        return [], [], [], []
    a, b = plain[0].encode(" " + text, add_special_tokens=False).ids, plain[1].encode(text)
    whole = (" " + text).encode()
    if b"".join(both.a_bytes[i] for i in a) != whole or b"".join(both.b_bytes[i] for i in b) != whole:
        return [], [], [], []
    i = j = at_a = at_b = 0
    groups, group = [], ([], [])
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            group[0].append(a[i])
            at_a += len(both.a_bytes[a[i]])
            i += 1
        else:
            group[1].append(b[j])
            at_b += len(both.b_bytes[b[j]])
            j += 1
        if at_a == at_b:
            groups.append(group)
            group = ([], [])
    return a, b, groups, [(x[-1], y[-1]) for x, y in groups]


def spelled(groups):
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)


ODD = [
    None,
    "",
    " ",
    "one",
    "a  b\t\n c",
    "<|endoftext|> and <s> </s> <unk>",
    "Zażółć gęślą jaźń, größer als 中文 和 日本語 العربية 😀👩‍👩‍👧",
    "a▁b",
    "x" * 5000,
    "word " * 4000,
    "\x00\x01 tail ",
    "  lead",
]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, i) for i, t in enumerate(ODD)] + [(None, "no id", 1), (3, "one", 3), (3, "one", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_a int")


def expected(rows, plain, both):
    found = [(i, *walk(t, plain, both)) for i, t in rows]
    counts = Counter(link for *_, links in found for link in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (
            i,
            len(a),
            len(b),
            len(groups),
            len(links),
            sum(counts[x] == best[x[1]] for x in links),
            sum(counts[x] for x in links),
            hashlib.sha256(spelled(groups).encode()).hexdigest() if groups else "",
        )
        for i, a, b, groups, links in found
    ]


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


@pytest.mark.parametrize("limit", [al.BROADCAST_PAIRS, 0])
def test_odd_rows_against_the_walk(spark, table, plain, both, limit):
    got = [tuple(r) for r in al.alignment_summary(table, broadcast_pairs=limit).collect()]
    want = expected([(r.doc_id, r.text) for r in table.collect()], plain, both)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_documents_against_the_walk(documents, plain, both):
    got = [tuple(r) for r in al.alignment_summary(documents).collect()]
    want = expected([(r.doc_id, r.text) for r in documents.collect()], plain, both)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert any(r[1] for r in got)


def test_blocks_do_not_change_the_result(both, monkeypatch):
    texts = [t for t in ODD if t] * 3
    wanted = ("groups", "overlap_links", "group_links")
    whole = al.align_texts(texts, both, wanted)
    monkeypatch.setattr(al, "BLOCK", 64)
    small = al.align_texts(texts, both, wanted)
    for x, y in zip(whole, small, strict=True):
        assert (x.groups, x.sha.hexdigest()) == (y.groups, y.sha.hexdigest())
        assert ";".join(x.text) == ";".join(y.text)
        assert x.overlaps == y.overlaps and x.shared == y.shared


def test_links_by_position(spark, both):
    docs = spark.createDataFrame([(1, "größer als 中文 tokenization")], "doc_id long, text string")
    row = al.align_tokenizers(docs, outputs=("groups", "overlap_links", "group_links")).first()
    (a, b), *_ = both.tokens(["größer als 中文 tokenization"])
    ranges = [np.cumsum(np.concatenate([[0], sizes[ids]])) for sizes, ids in ((both.a_sizes, a), (both.b_sizes, b))]
    overlap, shared = [], []
    for i in range(len(a)):
        for j in range(len(b)):
            common = min(ranges[0][i + 1], ranges[1][j + 1]) - max(ranges[0][i], ranges[1][j])
            if common > 0:
                overlap.append((i, j, common))
    group = {}
    at = [0, 0]
    for g, part in enumerate(row.groups.split(";")):
        for side, ids in enumerate(part.split("|")):
            for _ in ids.split(","):
                group[side, at[side]] = g
                at[side] += 1
    shared = [(i, j) for i in range(len(a)) for j in range(len(b)) if group[0, i] == group[1, j]]
    assert [tuple(x) for x in row.overlap_links] == overlap
    assert [tuple(x) for x in row.group_links] == shared


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert al.alignment_summary(docs).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 8), st.integers(1, 8), st.integers(1, 8), st.randoms(use_true_random=False))
def test_product(n, m, k, rnd):
    x = np.array([[rnd.choice([0, 0, 1, 2]) for _ in range(m)] for _ in range(n)])
    y = np.array([[rnd.choice([0, 0, 1, 3]) for _ in range(k)] for _ in range(m)])

    def csr(d):
        rows, cols = np.nonzero(d)
        return al.Csr(np.concatenate([[0], np.cumsum((d != 0).sum(axis=1))]), cols, d[rows, cols], d.shape[1])

    def dense(c):
        d = np.zeros((len(c.indptr) - 1, c.columns), int)
        d[c.rows(), c.indices] = c.data
        return d

    assert (dense(al.product(csr(x), csr(y))) == x @ y).all()
    assert (dense(al.transposed(csr(x))) == x.T).all()
