"""Contiguous shards of near equal size whose largest is as small as can be (operator 9, DataFrame functions only).

Rows with equal texts form an atomic group. Groups stand in one order: first those that are larger than an equal
share of what is left (each gets a shard of its own, as no cut can help it), then the others by a 60-bit key of their
text. Over the latter the smallest capacity is searched for which greedy cutting needs no more shards than there are.

The search never sees single groups of all data. It holds weights of key ranges: 4,096 ranges first, and finer ones
only where a cut can fall. For capacities between `low` and `high` the k-th greedy cut lies between what greedy
cutting reaches with whole ranges at `low` and k times `high`; ranges outside those windows are never cut. When the
windows hold single groups only, searching over the ranges gives the exact answer. A round fetches at most
`FETCHED` rows, whatever the size of the data; the number of rounds grows with the logarithm of the group count.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histora.llm.common import saved

KEY_BITS = 60
FETCHED = 1 << 17
CELLS = 4096

Range = tuple[int, int, int, int, int]
"""First key, shift (the range has 2**shift keys), weight, largest group, number of groups."""


def text_key(text: Column) -> Column:
    """The first 60 bits of the text's MD5. Equal texts share it; should others do so too, they stay together."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def cuts(weights: list[int], sums: list[int], capacity: int, most: int) -> list[int]:
    """Greedy cutting: the index after the last range of each shard, for `most` shards at most.

    A range heavier than the capacity stops it early.
    """
    found, at = [], 0
    while at < len(weights) and len(found) < most:
        base = sums[at - 1] if at else 0
        after = bisect_right(sums, base + capacity, lo=at)
        if after == at:
            break
        found.append(after)
        at = after
    return found


def feasible(weights: list[int], sums: list[int], capacity: int, shards: int) -> bool:
    found = cuts(weights, sums, capacity, shards)
    return not weights or bool(found) and found[-1] == len(weights)


def smallest_capacity(weights: list[int], shards: int, low: int) -> int:
    """Binary search for the smallest capacity, `low` or more, for which `shards` shards are enough."""
    sums = list(accumulate(weights))
    low = max(low, max(weights, default=0), -(-sum(weights) // shards))
    high = max(low, sum(weights))
    while low < high:
        middle = (low + high) // 2
        if feasible(weights, sums, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def undecided(ranges: list[Range], shards: int) -> list[Range]:
    """Ranges of several groups that a greedy cut can fall into."""
    weights = [r[2] for r in ranges]
    sums = list(accumulate(weights))
    total = sums[-1] if sums else 0
    low = max(max((r[3] for r in ranges), default=0), -(-total // shards))
    heavy = [r for r in ranges if r[4] > 1 and r[2] * 64 > low]
    if heavy:
        return heavy
    high = smallest_capacity(weights, shards, low)
    reached = cuts(weights, sums, low, shards - 1)
    found: dict[int, Range] = {}
    for k, after in enumerate(reached, start=1):
        for i in range(after, min(len(ranges), bisect_right(sums, k * high) + 1)):
            if ranges[i][4] > 1:
                found[i] = ranges[i]
    return list(found.values())


def minimax_cuts(fetch: Callable[[int, list[int] | None, int], list[tuple[int, int, int, int]]], shards: int) -> list[int]:
    """First keys of the shards after the first one.

    fetch(shift, parents, parent_shift) gives (key >> shift, weight, largest group, groups) of the groups whose
    key >> parent_shift is one of the parents (all groups if None).
    """
    shift = KEY_BITS - 12
    ranges = sorted((p << shift, shift, w, g, n) for p, w, g, n in fetch(shift, None, KEY_BITS))
    while finer := undecided(ranges, shards):
        # one level at a time: the ranges of the coarsest level first
        shift = max(r[1] for r in finer)
        finer = [r for r in finer if r[1] == shift][: FETCHED // 2]
        bits = min(12, shift, max(1, (FETCHED // len(finer)).bit_length() - 1))
        split = fetch(shift - bits, [r[0] >> shift for r in finer], shift)
        gone = {r[0] for r in finer}
        ranges = [r for r in ranges if r[0] not in gone or r[1] != shift]
        ranges = sorted(ranges + [(p << (shift - bits), shift - bits, w, g, n) for p, w, g, n in split])
    weights = [r[2] for r in ranges]
    capacity = smallest_capacity(weights, shards, 0)
    found = cuts(weights, list(accumulate(weights)), capacity, shards)
    return [ranges[i][0] for i in found if i < len(ranges)]


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put every row into one of `shards` shards so that the largest shard has as few bytes as can be.

    Returns id_col, size (UTF-8 bytes of the text plus 1), text_crc32, law ('bytes'), shard, slot (gapless from 0 in
    each shard) and grown_shard (null: the law has no answer for one more shard).

    Rows with equal texts share a shard. A null text counts as an empty one, a null id is an id like others, repeated
    rows each get a slot, other columns are not read, and an empty table gives no rows. With fewer groups than shards
    some shards stay empty.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = saved(
        docs.select(
            F.col(id_col).alias("id"),
            text_key(text).alias("g"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
        ),
        "shard-rows",
    )
    groups = saved(rows.groupBy("g").agg(F.sum("size").alias("w")), "shard-groups")

    total = groups.agg(F.sum("w")).first()[0] or 0
    large, left, alone = groups.orderBy(F.desc("w"), "g").limit(shards).collect(), shards, []
    for g in large:
        if left == 1 or g.w * left <= total:
            break
        alone.append(g.g)
        total, left = total - g.w, left - 1
    others = groups.where(~F.col("g").isin(alone)) if alone else groups

    def fetch(shift: int, parents: list[int] | None, parent_shift: int) -> list[tuple[int, int, int, int]]:
        part = others if parents is None else others.where(F.shiftright("g", parent_shift).isin(parents))
        part = part.groupBy(F.shiftright("g", shift).alias("p"))
        return [tuple(r) for r in part.agg(F.sum("w"), F.max("w"), F.count("*")).collect()]

    shard = F.lit(len(alone))
    for key in minimax_cuts(fetch, left):
        shard = shard + (F.col("g") >= F.lit(key)).cast("int")
    for i, key in reversed(list(enumerate(alone))):
        shard = F.when(F.col("g") == F.lit(key), F.lit(i)).otherwise(shard)

    # Slots: rows are numbered within cells, which also split a large group, and cells within shards.
    mark = F.md5(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("g")).cast("binary"))
    rows = rows.withColumns(
        {"shard": shard.cast("int"), "cell": F.conv(F.substring(mark, 1, 8), 16, 10).cast("long") % CELLS}
    )
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    cells = cells.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "cell").orderBy("id", "g")
    return (
        rows.withColumn("place", F.row_number().over(within) - 1)
        .join(cells, ["shard", "cell"])
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
