"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment (operator 6).

1. Grams of the test items are counted over all documents (one pass; only grams that occur in an item are emitted).
2. Seeds of an item are the rarer three quarters of its grams by that count, ties in item order. No item is without
   seeds, however often its passage occurs.
3. A second pass looks the seeds up in every document. Seeds of one item that lie close together give a window; the
   item (of fewer than three words: one gram of them all) is aligned with the whole window. Words that agree score 2, others -1, and a gap costs 1 per word.
4. A document holds an item if the best local alignment reaches `threshold` of the score of a verbatim copy.

The item side is broadcast in blocks of at most `block_words` words, so its size is bounded; each block takes its passes.
Documents are never shuffled.
"""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import ascii_words, ship

MATCH, MISMATCH, GAP = 2, -1, 1
#: Letters of scripts that put no blanks between words (Thai to Tibetan, Burmese, Khmer, kana, Han): each is a word of its own
UNSEGMENTED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


class PlainHashes(dict):
    """64-bit hashes of words without the punctuation around them; 0 for punctuation only. Those met first are kept."""

    def __missing__(self, word: bytes) -> int:
        plain = word.strip(b".,;:!?\"'()[]{}*#$%&|")
        found = xxhash.xxh3_64_intdigest(plain) or 1 if plain else 0
        if len(self) < 60_000:
            self[word] = found
        return found


HASHES = PlainHashes()


def plain_words(text: str | None):
    """64-bit hashes of the words without punctuation around them; words of punctuation only are left out."""
    import numpy as np

    if text and not text.isascii() and UNSEGMENTED.search(text):
        text = UNSEGMENTED.sub(r" \g<0> ", text)
    words = ascii_words(text)
    found = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    return found[found != 0]


class Known:
    """A set of grams. A table of marks by their lower bits lets few others through to the search."""

    def __init__(self, keys):
        import numpy as np

        self.keys = keys
        self.marks = np.zeros(1 << 22, bool)
        self.marks[keys & (len(self.marks) - 1)] = True

    def places(self, found):
        """Places in `found` that hold a known gram."""
        import numpy as np

        at = np.flatnonzero(self.marks[found & (len(self.marks) - 1)])
        if not len(at):
            return at
        near = np.minimum(np.searchsorted(self.keys, found[at]), len(self.keys) - 1)
        return at[self.keys[near] == found[at]]


def grams(words, width: int):
    """Hashes of the grams of `width` words; a shorter text is one gram."""
    import numpy as np

    if not len(words):
        return np.empty(0, np.int64)
    k = min(width, len(words))
    n = len(words) - k + 1
    x = np.full(n, k, np.uint64)
    for i in range(k):
        x = x * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def document_grams(words, widths: list[int]):
    """Hashes of the grams of all these widths and the places where they start."""
    import numpy as np

    parts = [grams(words, k) for k in widths if k <= len(words)]
    places = [np.arange(len(g)) for g in parts]
    none = np.empty(0, np.int64)
    return (parts[0], places[0]) if len(parts) == 1 else (np.concatenate([*parts, none]), np.concatenate([*places, none]))


def align(item, window) -> tuple[int, int, int]:
    """Best local score of two word sequences, and the words [start, end) of the window that it covers."""
    import numpy as np

    n = len(window)
    steps = np.arange(n + 1) * GAP
    h, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for w in item:
        diagonal = h[:-1] + np.where(window == w, MATCH, MISMATCH)
        up = h[1:] - GAP
        row = np.zeros(n + 1, np.int64)
        source = np.arange(n + 1)
        row[1:] = np.maximum(np.maximum(diagonal, up), 0)
        source[1:] = np.where(row[1:] == 0, source[1:], np.where(diagonal >= up, begin[:-1], begin[1:]))
        # a gap along the window: the best value further left less its distance
        level = row + steps
        top = np.maximum.accumulate(level)
        at = np.maximum.accumulate(np.where(level == top, np.arange(n + 1), 0))
        h, begin = top - steps, source[at]
        end = int(np.argmax(h))
        if h[end] > best[0]:
            best = (int(h[end]), int(begin[end]), end)
    return best


def windows(places, ahead, behind):
    """Merge [place - ahead, place + behind) of sorted places that touch."""
    found: list[list[int]] = []
    for p, a, b in zip(places, ahead, behind, strict=True):
        if found and p - a <= found[-1][1]:
            found[-1][0] = min(found[-1][0], p - a)
            found[-1][1] = max(found[-1][1], p + b)
        else:
            found.append([p - a, p + b])
    return found


def matches(docs: DataFrame, items: list[tuple], width: int, threshold: float) -> DataFrame:
    """docs: id, text; items: (item id, text). Gives id, item_id, score, first_word and last_word."""
    import numpy as np
    import pyarrow as pa

    spark = docs.sparkSession
    words = [plain_words(t) for _, t in items]
    each = [grams(w, width) for w in words]
    # an item of fewer words is one gram, so documents need grams of that width as well
    widths = sorted({min(width, len(w)) for w in words if len(w)})
    every = np.unique(np.concatenate([*each, np.empty(0, np.int64)]))
    known = spark.sparkContext.broadcast(every)

    def occurrences(batches):
        held = Known(known.value)
        for batch in batches:
            counts = np.zeros(len(held.keys), np.int64)
            for at in range(0, batch.num_rows, 1000):
                for text in batch.column(0).slice(at, 1000).to_pylist():
                    found, _ = document_grams(plain_words(text), widths)
                    found = found[held.places(found)]
                    if len(found):
                        counts[np.searchsorted(held.keys, np.unique(found))] += 1
            hit = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(held.keys[hit]), pa.array(counts[hit])], names=["gram", "n"])

    counted = docs.select("text").mapInArrow(occurrences, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    often = dict(counted.toLocalIterator())  # one row per item gram at most

    seeds: list[tuple[int, int, int]] = []
    for i, g in enumerate(each):
        order = sorted(range(len(g)), key=lambda p, g=g: (often.get(int(g[p]), 0), p))
        seeds += [(int(g[p]), i, p) for p in order[: (3 * len(g) + 3) // 4]]
    seeds.sort()
    table = np.array(seeds, np.int64).reshape(-1, 3)
    shared = spark.sparkContext.broadcast((table, words, [k for k, _ in items]))

    def find(held: Known, text: str | None):
        table, words, ids = shared.value
        own = plain_words(text)
        g, place = document_grams(own, widths)
        hit = held.places(g)
        if not len(hit):
            return []
        low = np.searchsorted(table[:, 0], g[hit])
        high = np.searchsorted(table[:, 0], g[hit], side="right")
        by_item: dict[int, list[tuple[int, int]]] = {}
        for p, a, b in zip(place[hit].tolist(), low.tolist(), high.tolist(), strict=True):
            for s in range(a, b):
                by_item.setdefault(int(table[s, 1]), []).append((p, int(table[s, 2])))
        out = []
        for i, places in by_item.items():
            n = len(words[i])
            slack = n // 2 + width
            spans = windows(
                [p for p, _ in places], [at + slack for _, at in places], [n - at + slack for _, at in places]
            )
            best = (0, 0, 0)
            for a, b in spans:
                a = max(0, a)
                score, start, end = align(words[i], own[a:b])
                if score > best[0]:
                    best = (score, a + start, a + end)
            if best[0] >= threshold * MATCH * n:
                out.append((ids[i], best[0] / (MATCH * n), best[1], best[2]))
        return sorted(out, key=lambda x: (-x[1], x[0]))

    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        held = Known(np.unique(shared.value[0][:, 0]))
        for batch in batches:
            which, rows = [], []
            for start in range(0, batch.num_rows, 1000):
                for at, text in enumerate(batch.column(1).slice(start, 1000).to_pylist(), start):
                    for r in find(held, text):
                        which.append(at)
                        rows.append(r)
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which, pa.int64()))]
                + [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.float64(), pa.int64(), pa.int64()), strict=True)],
                names=["id", "item_id", "score", "first_word", "last_word"],
            )

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, item_id long, score double, first_word long, last_word long")


def item_blocks(items: DataFrame, block_words: int):
    """The test items in lists of at most `block_words` words (one item at least), one list in memory at a time."""
    block: list[tuple] = []
    size = 0
    for r in items.orderBy("item_id", "text").toLocalIterator():
        n = len(ascii_words(r.text))
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((r.item_id, r.text))
        size += n
    if block:
        yield block


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    width: int = 3,
    threshold: float = 0.5,
    block_words: int = 1_000_000,
) -> DataFrame:
    """Documents that hold a test item: id_col, item_id, score (1: verbatim), first_word and last_word (words
    without punctuation-only ones, from 0, the last one excluded); one row per document row and item.

    Case (A-Z) and punctuation around words don't count. Letters of scripts without blanks between words are words of their
    own. An item of fewer words than `width` is found wherever it stands word for word. Null, empty or blank texts and items match nothing. Rows with a
    null id come back with it, repeated rows repeatedly, repeated items once. Items with a null id are not looked for.
    Other columns are not read. An empty table on either side gives no rows.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    items = items.where(F.col("item_id").isNotNull() & (F.trim("text") != "")).dropDuplicates()
    found = None
    for block in item_blocks(items, block_words):
        part = matches(docs, block, width, threshold)
        found = part if found is None else found.union(part)
    if found is None:
        found = matches(docs.limit(0), [], width, threshold)
    return found.withColumnRenamed("id", id_col)
