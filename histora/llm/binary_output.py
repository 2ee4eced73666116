"""Packed token ids as binary matrices (operator 8): best-fit-decreasing with a segment tree, per shard.

Texts become ids with a closing id; longer ones are cut into pieces without loss. Pieces are dealt to shards of about
`shard_tokens` ids by their place in the input, which no hot key can crowd. A shard is packed by one task: the longest piece first,
each into the fullest sequence that has room. The free capacities are the leaves of a segment tree whose nodes say
whether a sequence lies below, so the smallest sufficient capacity is found in log2(capacity) steps.

Every sequence is written as one row: ids (`capacity` little-endian unsigned numbers of 16 bits, or 32 for a larger vocabulary;
the rest is padding), cu_seqlens (where segments start, and the end of the last), resets (a bit per place,
lowest bit first: positions start anew there) and what each segment is: doc_ids, pieces, starts.
"""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import ship
from histora.llm.tokens import SEPARATOR, tokenizer, tokenizer_path
from histora.workspace import fresh_path


class Capacities:
    """Sequences by free capacity, found by the smallest capacity that is enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, free: int, sequence: int) -> None:
        self.open[free].append(sequence)
        at = self.leaves + free
        while at and not self.tree[at]:
            self.tree[at] = 1
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(capacity, sequence) with the least capacity >= size; None if there is none."""
        at = self.leaves + size
        while not self.tree[at]:
            # the next subtree to the right, or none
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at *= 2
            at += not self.tree[at]
        free = at - self.leaves
        sequence = self.open[free].pop()
        if not self.open[free]:
            self.tree[at] = 0
            at >>= 1
            while at and not (self.tree[2 * at] or self.tree[2 * at + 1]):
                self.tree[at] = 0
                at >>= 1
        return free, sequence


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Numbers of the pieces in each sequence."""
    rooms, found = Capacities(capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        room = rooms.take(sizes[i])
        free, sequence = room or (capacity, len(found))
        if room is None:
            found.append([])
        found[sequence].append(i)
        if free > sizes[i]:
            rooms.put(free - sizes[i], sequence)
    return found


def dealt_pieces(docs: DataFrame, capacity: int, path: str, shards: int, number: str) -> DataFrame:
    """docs: id, text. Pieces (shard, doc_id, piece, start, ids in numbers of the given kind)."""
    import numpy as np
    import pyarrow as pa

    width = np.dtype(number).itemsize

    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        task, row = TaskContext.get().partitionId(), 0
        coder = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                which, where, pieces, starts, ids = [], [], [], [], []
                for i, data in enumerate(coder.ids([t or "" for t in part.column(1).to_pylist()])):
                    data = np.frombuffer(data + SEPARATOR, "<u4").astype(number).tobytes()
                    n, begin = len(data) // width, 0
                    for piece in range(-(-n // capacity)):
                        end = min(n, begin + capacity)
                        which.append(i)
                        where.append(zlib.crc32(b"%d %d" % (task, row)) % shards)
                        pieces.append(piece)
                        starts.append(begin)
                        ids.append(data[width * begin : width * end])
                        begin, row = end, row + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(where, pa.int32()),
                        part.column(0).take(pa.array(which, pa.int64())),
                        pa.array(pieces, pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["shard", "doc_id", "piece", "start", "ids"],
                )

    return docs.mapInArrow(run, f"shard int, doc_id {kind}, piece int, start long, ids binary")


def write_packed(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    shard_tokens: int = 1 << 21,
    padding: int = 0,
    tokenizer_file: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the packed sequences below `path` as Parquet and return them (see the module for the columns).

    Null and empty texts have the closing id only. Rows with a null id and repeated rows are packed each by itself; other columns
    are not read. An empty table writes no rows.
    """
    import numpy as np

    ship(docs.sparkSession)
    file = tokenizer_file or tokenizer_path()
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # an id stands for a byte at least, so a shard has at most about shard_tokens ids
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")).first()[0] or 0
    shards = max(1, -(-size // (3 * shard_tokens)))
    number = "<u4" if tokenizer(file).whole.get_vocab_size() > 1 << 16 else "<u2"
    width = np.dtype(number).itemsize
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"shard int, sequence int, ids binary, cu_seqlens array<int>, resets binary, doc_ids array<{kind}>, pieces array<int>, starts array<long>"

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # an order of its own, whatever order the rows arrive in
        pdf = pdf.assign(order=[zlib.crc32(x) for x in pdf.ids]).sort_values(["doc_id", "piece", "order"], kind="stable", ignore_index=True)
        rows = []
        names, pieces, starts = list(pdf.doc_id), pdf.piece.to_numpy(), pdf.start.to_numpy()
        for sequence, members in enumerate(best_fit_decreasing([len(x) // width for x in pdf.ids], capacity)):
            ids = np.frombuffer(b"".join(pdf.ids[i] for i in members), number)
            ends = np.cumsum([0, *(len(pdf.ids[i]) // width for i in members)])
            full = np.full(capacity, padding, number)
            full[: len(ids)] = ids
            resets = np.zeros(capacity, bool)
            resets[ends[:-1]] = True
            rows.append(
                (key[0], sequence, full.tobytes(), ends.astype(np.int32).tolist(), np.packbits(resets, bitorder="little").tobytes())
                + ([None if pd.isna(names[i]) else names[i] for i in members], pieces[members].tolist(), starts[members].tolist())
            )
        return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in schema.split(", ")])

    pieces = dealt_pieces(docs, capacity, file, shards, number)
    pieces.groupBy("shard").applyInPandas(pack, schema).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def segments(packed: DataFrame) -> DataFrame:
    """The segments of written sequences, from their binary columns alone: doc_id, piece, start, length, ids_crc32
    (ids as little-endian unsigned 32-bit numbers), shard, sequence, offset, and position_resets of the sequence."""
    import numpy as np
    import pyarrow as pa

    ship(packed.sparkSession)
    kind = packed.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            which, lengths, checks, offsets, resets = [], [], [], [], []
            for i, (ids, ends, bits) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)), strict=True)):
                wide = 4 if len(ids) // 4 * 8 == len(bits) * 64 else 2
                ids = np.frombuffer(ids, "<u4" if wide == 4 else "<u2").astype("<u4")
                marks = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
                for a, b in zip(ends, ends[1:], strict=False):
                    which.append(i)
                    lengths.append(b - a)
                    checks.append(zlib.crc32(ids[a:b].tobytes()))
                    offsets.append(a)
                    resets.append(len(marks))
            take = lambda c: batch.column(c).take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).flatten() for c in (5, 6, 7)]
                + [pa.array(x, pa.int64()) for x in (lengths, checks)]
                + [take(0), take(1), pa.array(offsets, pa.int64()), pa.array(resets, pa.int32())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "shard", "sequence", "offset", "position_resets"],
            )

    return packed.mapInArrow(
        run,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, shard int, sequence int, offset long, position_resets int",
    )


def packed_output(docs: DataFrame, capacity: int = 2048, **options) -> DataFrame:
    """Write packed matrices to the shared folder and return the segments found in what was written."""
    return segments(write_packed(docs, fresh_path(docs.sparkSession, "packed"), capacity, **options))
