"""Token by token alignment of two tokenizers over the same bytes (operator 11).

Both tokenizers cut the same bytes (a space and the text), so a token is a run of bytes. The token-byte incidence matrices A
and B are kept in CSR form built here. Gustavson's row products give

* A . B^T: the overlap links, pairs of tokens that share bytes, with the number of bytes they share;
* G_A . G_B^T, of the token-group incidence matrices: the shared-group links. A group ends wherever tokens of both end.

Both products are block diagonal over groups, so a long text is worked off in blocks that end where groups do, and many short
texts share a block. Memory depends on the block size, not on the text, except for the lists of its token ids.

How often a pair of ids is linked is counted over the whole corpus by Spark; each document then looks its pairs up.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import saved, ship
from histora.llm.tokens import TextTokenizer, tokenizer_path

#: Bytes of text that one product works on
BLOCK = 1 << 18
#: Texts tokenized at a time
TEXTS = 200
#: Pairs of ids up to which their counts are broadcast (about 100 MB); beyond it they are joined by an exchange
BROADCAST_PAIRS = 1_000_000


class Csr(NamedTuple):
    """A sparse matrix by rows: row i holds `indices[indptr[i]:indptr[i + 1]]`."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))


def _pointers(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)])


def token_bytes(lengths: np.ndarray) -> Csr:
    """Tokens by bytes: a token holds the bytes after those of the tokens before it."""
    indptr = _pointers(lengths)
    total = int(indptr[-1])
    return Csr(indptr, np.arange(total), np.ones(total, np.int64), total)


def token_groups(group: np.ndarray, groups: int) -> Csr:
    """Tokens by groups: one entry a token."""
    return Csr(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), groups)


def transposed(m: Csr) -> Csr:
    order = np.argsort(m.indices, kind="stable")
    indptr = _pointers(np.bincount(m.indices, minlength=m.columns))
    return Csr(indptr, m.rows()[order], m.data[order], len(m.indptr) - 1)


def product(left: Csr, right: Csr) -> Csr:
    """Gustavson's product: a row of the result adds up the rows of `right` that the entries of the row of `left` name."""
    meets = np.diff(right.indptr)[left.indices]
    first = np.cumsum(meets) - meets
    at = np.repeat(right.indptr[left.indices] - first, meets) + np.arange(int(meets.sum()))
    key = np.repeat(left.rows(), meets) * right.columns + right.indices[at]
    value = np.repeat(left.data, meets) * right.data[at]
    if len(key) and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
    row, column = np.divmod(key[new], max(right.columns, 1))
    indptr = _pointers(np.bincount(row, minlength=len(left.indptr) - 1))
    return Csr(indptr, column, np.add.reduceat(value, new) if len(new) else value, right.columns)


class Aligned(NamedTuple):
    """What a block gives: overlap links (token of A, token of B, bytes), the links that end a group, groups of the tokens."""

    a: np.ndarray
    b: np.ndarray
    shared: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray


def aligned(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Aligned:
    """Align tokens, given by their lengths in bytes, over the same bytes."""
    overlap = product(token_bytes(a_lengths), transposed(token_bytes(b_lengths)))
    a, b = overlap.rows(), overlap.indices
    together = np.cumsum(a_lengths)[a] == np.cumsum(b_lengths)[b]
    last_a, last_b = a[together], b[together]
    group_a = np.searchsorted(last_a, np.arange(len(a_lengths)))
    group_b = np.searchsorted(last_b, np.arange(len(b_lengths)))
    return Aligned(a, b, overlap.data, last_a, last_b, group_a, group_b)


def shared_group_links(found: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a token of A and a token of B in one group."""
    groups = len(found.last_a)
    links = product(token_groups(found.group_a, groups), transposed(token_groups(found.group_b, groups)))
    return links.rows(), links.indices


def parts(a_ends: np.ndarray, b_ends: np.ndarray, size: int) -> list[tuple[int, int, int, int]]:
    """Ranges of tokens (from, to in A; from, to in B) of about `size` bytes that end where groups do."""
    if not len(a_ends) or a_ends[-1] <= size:
        return [(0, len(a_ends), 0, len(b_ends))]
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    cuts, at = [], 0
    while at < a_ends[-1]:
        within = common[np.searchsorted(common, at, "right") : np.searchsorted(common, at + size, "right")]
        # a group longer than the block is a block of its own
        at = int(within[-1]) if len(within) else int(common[np.searchsorted(common, at, "right")])
        cuts.append(at)
    a = [0, *(np.searchsorted(a_ends, cuts) + 1).tolist()]
    b = [0, *(np.searchsorted(b_ends, cuts) + 1).tolist()]
    return list(zip(a[:-1], a[1:], b[:-1], b[1:], strict=True))


def _byte_letters() -> dict[str, int]:
    """The letters of byte-level vocabularies: printable Latin-1 stands for itself, the other bytes for U+0100 and on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers with the bytes of their entries; special tokens in a text are ordinary text."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = TextTokenizer(a_path)
        self.a.whole.encode_special_tokens, self.a.special = True, []
        letters = _byte_letters()
        names = {i: name for name, i in self.a.whole.get_vocab(with_added_tokens=True).items()}
        known = [names.get(i, "") for i in range(max(names) + 1)]
        self.a_bytes = [bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in known]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8", "surrogatepass") for i, p in enumerate(pieces)
        ]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        # "5," and "5|" for ids of A, then "7," and "7;" for ids of B: token 2 * id + (it ends its group)
        marks = [(len(self.a_bytes), b"|"), (len(self.b_bytes), b";")]
        self.words = np.array([b"%d%s" % (i, m) for n, end in marks for i in range(n) for m in (b",", end)], object)

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B for every text; none where there is no text, or where the bytes of one differ from a space and the text."""
        full = [t for t in texts if t]
        a = [np.frombuffer(x, "<u4").astype(np.int64) for x in self.a.ids([" " + t for t in full])]
        b = self.b.encode(full, num_threads=1) if full else []
        none = np.zeros(0, np.int64)
        found = []
        for text, x, y in zip(full, a, b, strict=True):
            whole = b" " + text.encode("utf-8", "surrogatepass")
            same = b"".join([self.b_bytes[i] for i in y]) == whole and b"".join([self.a_bytes[i] for i in x.tolist()]) == whole
            found.append((x, np.array(y, np.int64)) if same else (none, none))
        rest = iter(found)
        return [next(rest) if t else (none, none) for t in texts]


_PAIRS: dict[tuple[str, str], Pair] = {}


def tokenizer_pair(a_path: str, b_path: str) -> Pair:
    """One pair of tokenizers per worker process."""
    if (a_path, b_path) not in _PAIRS:
        _PAIRS[a_path, b_path] = Pair(a_path, b_path)
    return _PAIRS[a_path, b_path]


class Document:
    """What the blocks of one document add up to."""

    def __init__(self, a: int, b: int):
        self.n_a, self.n_b, self.groups, self.sha, self.codes = a, b, 0, hashlib.sha256(), []
        self.text, self.overlaps, self.shared = [], [], []


def spelled(found: Aligned, a: np.ndarray, b: np.ndarray, both: Pair) -> np.ndarray:
    """The words of `a1,a2|b1;...` in their order."""
    ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    ends_a[found.last_a], ends_b[found.last_b] = 1, 1
    groups = len(found.last_a)
    # the columns of the incidence matrices added up: tokens of each group
    sizes_a, sizes_b = np.bincount(found.group_a, minlength=groups), np.bincount(found.group_b, minlength=groups)
    place = np.empty(len(a) + len(b), np.int64)
    place[np.arange(len(a)) + (np.cumsum(sizes_b) - sizes_b)[found.group_a]] = 2 * a + ends_a
    place[np.arange(len(b)) + np.cumsum(sizes_a)[found.group_b]] = 2 * (len(both.a_bytes) + b) + ends_b
    return both.words[place]


def align_texts(texts: list[str | None], both: Pair, wanted: tuple[str, ...] = ()) -> list[Document]:
    tokens = both.tokens(texts)
    documents = [Document(len(a), len(b)) for a, b in tokens]
    block: list[tuple[int, int, int, int, int]] = []
    held = 0
    for d, (a, b) in enumerate(tokens):
        if not len(a):
            continue
        a_ends, b_ends = np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b])
        for a0, a1, b0, b1 in parts(a_ends, b_ends, BLOCK):
            size = int(a_ends[a1 - 1] - (a_ends[a0 - 1] if a0 else 0))
            if held and held + size > BLOCK:
                _work(block, tokens, documents, both, wanted)
                block, held = [], 0
            block.append((d, a0, a1, b0, b1))
            held += size
    if block:
        _work(block, tokens, documents, both, wanted)
    return documents


def _work(block, tokens, documents: list[Document], both: Pair, wanted: tuple[str, ...]) -> None:
    a = np.concatenate([tokens[d][0][a0:a1] for d, a0, a1, _, _ in block])
    b = np.concatenate([tokens[d][1][b0:b1] for d, _, _, b0, b1 in block])
    found = aligned(both.a_sizes[a], both.b_sizes[b])
    words = spelled(found, a, b, both)
    codes = a[found.last_a] * len(both.b_bytes) + b[found.last_b]
    links = shared_group_links(found) if "group_links" in wanted else None
    at_a = at_b = 0
    for d, a0, a1, b0, b1 in block:
        doc, to_a, to_b = documents[d], at_a + a1 - a0, at_b + b1 - b0
        low, high = np.searchsorted(found.last_a, [at_a, to_a])
        spelling = b"".join(words[at_a + at_b : to_a + to_b].tolist())[:-1]
        doc.sha.update(b";" * bool(doc.groups) + spelling)
        doc.groups += int(high - low)
        doc.codes.append(codes[low:high])
        if "groups" in wanted:
            doc.text.append(spelling.decode())
        if "overlap_links" in wanted:
            x, y = np.searchsorted(found.a, [at_a, to_a])
            doc.overlaps += zip((found.a[x:y] - at_a + a0).tolist(), (found.b[x:y] - at_b + b0).tolist(), found.shared[x:y].tolist(), strict=True)
        if links:
            x, y = np.searchsorted(links[0], [at_a, to_a])
            doc.shared += zip((links[0][x:y] - at_a + a0).tolist(), (links[1][x:y] - at_b + b0).tolist(), strict=True)
        at_a, at_b = to_a, to_b


#: What `align_tokenizers` can also give for each document; links name tokens by their positions
OUTPUTS = {
    "groups": "string",
    "overlap_links": "array<struct<a:long,b:long,bytes:long>>",
    "group_links": "array<struct<a:long,b:long>>",
}


def align_tokenizers(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    a_path: str | None = None,
    b_path: str | None = None,
    outputs: tuple[str, ...] = ("groups",),
) -> DataFrame:
    """Align the tokens of every text. Returns id_col, n_a, n_b, n_groups, groups_sha256 (of the spelled groups `a1,a2|b1;...`),
    linked (each pair of ids of A and B whose tokens end together, as id of A * entries of B + id of B, with its number) and `outputs`.

    Null and empty texts, and texts whose bytes one of the tokenizers does not keep, have no tokens: zeros, an empty
    groups_sha256 and empty lists. Repeated rows and null ids come back as they are; other columns are not read; an empty
    table gives no rows.
    """
    ship(docs.sparkSession)
    a_path, b_path = a_path or tokenizer_path(), b_path or tokenizer_path("piece_bpe_32k.model")
    schema = "n_a long, n_b long, n_groups long, groups_sha256 string, linked array<struct<pair:long,n:long>>"
    schema = ", ".join([schema, *(f"{name} {OUTPUTS[name]}" for name in outputs)])
    detail = {"groups": lambda d: ";".join(d.text), "overlap_links": lambda d: d.overlaps, "group_links": lambda d: d.shared}
    types = {
        "groups": pa.string(),
        "overlap_links": pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("bytes", pa.int64())])),
        "group_links": pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])),
    }

    def run(batches):
        both = tokenizer_pair(a_path, b_path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                found = align_texts(part.column(1).to_pylist(), both, outputs)
                pairs = [np.unique(np.concatenate(d.codes), return_counts=True) if d.codes else ((), ()) for d in found]
                entries = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate([p[k] for p in pairs]).astype(np.int64)) for k in (0, 1)], ["pair", "n"]
                )
                columns = [
                    part.column(0),
                    *(pa.array([getattr(d, c) for d in found], pa.int64()) for c in ("n_a", "n_b", "groups")),
                    pa.array([d.sha.hexdigest() if d.groups else "" for d in found], pa.string()),
                    pa.ListArray.from_arrays(pa.array(_pointers(np.array([len(p[0]) for p in pairs])).astype(np.int32)), entries),
                    *(pa.array([detail[c](d) for d in found], types[c]) for c in outputs),
                ]
                names = ["id", "n_a", "n_b", "n_groups", "groups_sha256", "linked", *outputs]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {schema}").withColumnRenamed("id", id_col)


def pair_counts(found: DataFrame, b_entries: int) -> DataFrame:
    """(pair, count, best) of every linked pair; best: no pair with the same id of B has a higher count."""
    counts = found.select(F.explode("linked").alias("l")).groupBy(F.col("l.pair").alias("pair")).agg(F.sum("l.n").alias("count"))
    counts = saved(counts, "pair-counts")
    highest = counts.groupBy((F.col("pair") % b_entries).alias("b")).agg(F.max("count").alias("highest"))
    return counts.join(highest, F.col("pair") % b_entries == F.col("b")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def alignment_summary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    a_path: str | None = None,
    b_path: str | None = None,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """One row a document: id_col, n_a, n_b, n_groups, n_links (tokens that end together), n_best (of these, links whose pair of ids
    is linked as often in the corpus as any with the same id of B), count_sum (of the links' pairs) and groups_sha256.

    The counts cover all documents, repeated rows included. See `align_tokenizers` for nulls, empty texts and empty tables.
    """
    import sentencepiece

    b_entries = sentencepiece.SentencePieceProcessor(model_file=b_path or tokenizer_path("piece_bpe_32k.model")).get_piece_size()
    found = align_tokenizers(docs, id_col, text_col, a_path, b_path, outputs=())
    # the number of a row is fixed by writing it
    found = saved(found.withColumn("__row", F.monotonically_increasing_id()), "aligned")
    counts = saved(pair_counts(found, b_entries), "pair-counts")
    known = F.broadcast(counts) if counts.count() <= broadcast_pairs else counts
    links = found.select("__row", F.explode("linked").alias("l")).select("__row", "l.pair", "l.n")
    sums = links.join(known, "pair").groupBy("__row").agg(
        F.sum("n").alias("n_links"),
        F.coalesce(F.sum(F.when(F.col("best"), F.col("n"))), F.lit(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_links", "n_best", "count_sum")}
    return found.join(sums, "__row", "left").select(id_col, "n_a", "n_b", "n_groups", *zero.values(), "groups_sha256")


