"""Packing documents into few fixed-size sequences (operator 1): dominance reduction, then best fit.

A piece only counts by its length, so the plan is made on the number of pieces of each length: `capacity` numbers at
most, whatever the size of the data. The plan says which lengths go together how often; Spark then numbers the pieces
of each length and looks their place up.

Reduction after Martello and Toth: a small set with piece j is fixed for good if it dominates every other set that
holds j, that is, if the pieces of any such set can be exchanged for those of the fixed one without a further
sequence. Lengths j are tried from the largest down:
* nothing fits beside j: {j};
* the largest i that fits fills the sequence, or two others never fit beside j: {j, i};
* three others never fit: {j, i} if no two pieces are larger together; else {j, a, b} with a = i, b the largest
  beside a, if no pair that fits has both members larger than b.
What is left goes from the largest to the smallest into the fullest sequence that has room, in runs of equal ones.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histora.llm.common import saved, ship
from histora.llm.tokens import SEPARATOR, tokenizer, tokenizer_path

CELLS = 4096

Content = tuple[tuple[int, int], ...]
"""(length, copies) in the order in which they lie in a sequence."""


@dataclass
class Run:
    """`count * copies` pieces of `length`, from number `first` of that length on, `copies` in each sequence."""

    length: int
    first: int
    count: int
    copies: int
    sequence: int
    offset: int


def reduce_by_dominance(pieces: dict[int, int], capacity: int) -> tuple[list[tuple[Content, int]], dict[int, int]]:
    """Fixed sequences with their number, and the pieces left. `pieces`: how many of each length."""
    left = {s: n for s, n in pieces.items() if n}
    order = sorted(left)
    fixed: list[tuple[Content, int]] = []

    def fits(room: int, used: dict[int, int]) -> int:
        """The largest length up to `room` of which pieces are left besides the used ones; 0 if none."""
        i = bisect_left(order, room + 1) - 1
        while i >= 0:
            if left[order[i]] > used.get(order[i], 0):
                return order[i]
            i -= 1
        return 0

    def smallest(used: int, most: int) -> list[int]:
        found: list[int] = []
        for s in order:
            found += [s] * min(left[s] - (s == used), most - len(found))
            if len(found) == most:
                break
        return found

    def fix(*lengths: int) -> None:
        need: dict[int, int] = {}
        for s in lengths:
            need[s] = need.get(s, 0) + 1
        times = min(left[s] // n for s, n in need.items())
        fixed.append((tuple(need.items()), times))
        for s, n in need.items():
            left[s] -= n * times
            if not left[s]:
                del left[s]
                del order[bisect_left(order, s)]

    for j in sorted(left, reverse=True):
        while left.get(j):
            room = capacity - j
            i = fits(room, {j: 1})
            if not i:
                fix(j)
                continue
            if i == room:
                fix(j, i)
                continue
            low = smallest(j, 3)
            if len(low) < 2 or low[0] + low[1] > room:
                fix(j, i)
                continue
            if len(low) == 3 and sum(low) <= room:
                break
            pairs = [(a, fits(room - a, {j: 1, a: 1 + (a == j)})) for a in order if left[a] > (a == j) and a < room]
            pairs = [(a, b) for a, b in pairs if b]
            if i >= max(a + b for a, b in pairs):
                fix(j, i)
                continue
            b = fits(room - i, {j: 1, i: 1 + (i == j)})
            if b and b >= max(min(pair) for pair in pairs):
                fix(j, i, b)
                continue
            break
    return fixed, left


def best_fit(pieces: dict[int, int], capacity: int) -> list[tuple[Content, int]]:
    """Best fit on decreasing lengths, over runs of equal sequences: contents with their number."""
    rooms: dict[int, list[tuple[Content, int]]] = {}
    order: list[int] = []

    def put(room: int, content: Content, count: int) -> None:
        if count:
            if room not in rooms:
                rooms[room] = []
                insort(order, room)
            rooms[room].append((content, count))

    for s in sorted(pieces, reverse=True):
        n = pieces[s]
        while n:
            at = bisect_left(order, s)
            if at < len(order):
                room = order[at]
                content, count = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    del order[at]
            else:
                room, content, count = capacity, (), n
            each = room // s
            full = min(count, n // each)
            rest = n - full * each if full < count else 0
            rest = min(rest, each)
            put(room - each * s, content + ((s, each),), full)
            if rest:
                put(room - rest * s, content + ((s, rest),), 1)
            if content:
                put(room, content, count - full - (rest > 0))
            n -= full * each + rest
    return [x for r in order for x in rooms[r]]


def plan(pieces: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Where the pieces of each length go, and the number of sequences."""
    fixed, left = reduce_by_dominance(pieces, capacity)
    runs, used, sequence = [], {}, 0
    for content, count in fixed + best_fit(left, capacity):
        offset = 0
        for length, copies in content:
            runs.append(Run(length, used.get(length, 0), count, copies, sequence, offset))
            used[length] = used.get(length, 0) + count * copies
            offset += length * copies
        sequence += count
    return runs, sequence


def pack(pieces: DataFrame, key: list[str], capacity: int, length_col: str = "length") -> DataFrame:
    """Add sequence_id and offset to pieces of 1 to `capacity` long; `key` tells pieces apart.

    `pieces` has to be a stored table: it is read three times. Pieces whose keys are equal (or null) still get places
    of their own. An empty table gives no rows. Fetched: one number per length, `capacity` at most.
    """
    import numpy as np

    ship(pieces.sparkSession)
    counts = {r[0]: r[1] for r in pieces.groupBy(length_col).agg(F.count("*")).collect()}
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths have to lie between 1 and {capacity}")
    runs, _ = plan(counts, capacity)
    runs.sort(key=lambda r: (r.length, r.first))
    step = max(counts.values(), default=0) + 1
    table = np.array([(r.length * step + r.first, r.copies, r.sequence, r.offset, r.length) for r in runs], dtype=np.int64)
    table = table.reshape(-1, 5)

    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        at = length.to_numpy(np.int64) * step + number.to_numpy(np.int64)
        r = table[np.searchsorted(table[:, 0], at, side="right") - 1]
        k = at - r[:, 0]
        return pd.DataFrame({"sequence_id": r[:, 2] + k // r[:, 1], "offset": r[:, 3] + k % r[:, 1] * r[:, 4]})

    placed = F.pandas_udf(place, "sequence_id long, offset long")

    # Numbers within a length: within cells, which split a frequent length, and cells within the length.
    cell = F.pmod(F.xxhash64(*key), F.lit(CELLS)).cast("int")
    rows = pieces.withColumn("__cell", cell)
    before = Window.partitionBy(length_col).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy(length_col, "__cell").agg(F.count("*").alias("__n"))
    cells = cells.select(length_col, "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    within = Window.partitionBy(length_col, "__cell").orderBy(*key)
    rows = rows.withColumn("__place", F.row_number().over(within) - 1).join(cells, [length_col, "__cell"])
    rows = rows.withColumn("__placed", placed(F.col(length_col), F.col("__first") + F.col("__place")))
    return rows.select(*pieces.columns, "__placed.sequence_id", "__placed.offset")


def token_pieces(docs: DataFrame, capacity: int, tokenizer_file: str, id_col: str, text_col: str, ids: bool) -> DataFrame:
    """Pieces of each document's ids followed by id 0: doc_id, piece, start, length, ids_crc32 (and the ids).

    Only documents longer than `capacity` are cut; the last pieces are full and the first one may be shorter. A null
    text counts as an empty one, which still has the closing id.
    """
    import pyarrow as pa

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else "")

    def cut(batches):
        coder = tokenizer(tokenizer_file)
        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 500):
                out: list[tuple] = []
                which: list[int] = []
                coded = coder.ids([t or "" for t in texts.slice(at, 500).to_pylist()])
                for row, data in enumerate(coded):
                    data += SEPARATOR
                    n = len(data) // 4
                    start = 0
                    for piece in range(-(-n // capacity)):
                        end = n - capacity * (-(-n // capacity) - piece - 1)
                        part = data[4 * start : 4 * end]
                        out.append((piece, start, end - start, zlib.crc32(part), part))
                        which.append(at + row)
                        start = end
                columns = list(zip(*out, strict=True)) or [[]] * 5
                arrays = [names.take(pa.array(which, pa.int64()))]
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                arrays += [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays[: 6 if ids else 5], names=schema_names)

    schema_names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if ids else 5]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame,
    capacity: int = 2048,
    tokenizer_file: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack the token ids of all documents into few sequences of at most `capacity` ids.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset, one row per piece. Null and empty texts
    are one closing id long; repeated rows and rows with a null id are packed each by itself; other columns are not read.
    """
    path = tokenizer_file or tokenizer_path()
    pieces = saved(token_pieces(docs, capacity, path, id_col, text_col, ids=False), "pieces")
    return pack(pieces, ["doc_id", "piece"], capacity)
