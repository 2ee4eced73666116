"""Near-duplicate documents by MinHash with sequential Bayesian verification (operator 3).

1. Every text becomes its set of shingles, a MinHash signature and band keys. Equal sets are one node from here on.
2. Nodes that share a band key are candidates. A first round compares each node with one partner only, the node among them that
   shares most keys with others. What that links needs no more comparing; in a large group of copies it links most.
3. A second round takes the candidates whose nodes are not linked yet. Keys held by up to `crowd` nodes give their
   pairs. For nodes under fuller keys an exact way finds every pair instead: sets that are similar enough share one of
   their rarest shingles, early enough in both (prefix and positional filter), so neither a passage that many texts have
   in common nor copies that are edited too much pair anybody.
4. Candidates are compared batch by batch of their signatures. After m equal values of n, the posterior of their
   similarity (uniform prior) gives the probability that it reaches the threshold; below `miss` the pair is dropped.
5. Survivors are confirmed on their full sets.

A pair at the threshold is in no common band with a probability of (1 - 0.75 ** 4) ** 32 = 5e-6; that and `miss` bound the loss.
Sets are compared by 64-bit hashes of their shingles, nodes are 64-bit hashes of whole sets.
"""

from __future__ import annotations

from math import comb

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histora.llm.common import Scratch, ascii_words, ship
from histora.llm.components import components

BANDS, ROWS = 32, 4
BATCH = 32


class WordHashes(dict):
    """64-bit hashes of words; those met first are kept."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 60_000:
            self[word] = h
        return h


HASHES = WordHashes()


def mixed(x):
    """A finaliser that spreads every bit of 64-bit numbers."""
    import numpy as np

    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, width: int = 5):
    """Sorted distinct 64-bit hashes of the shingles; fewer words than `width` are one shingle, no words none."""
    import numpy as np

    words = ascii_words(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    k = min(width, len(words))
    n = len(words) - k + 1
    x = np.full(n, k, np.uint64)
    for i in range(k):
        x = x * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    return np.unique(mixed(x))


def signature(shingles, factors, terms):
    """The smallest value of each hash function over the set, upper 32 bits."""
    import numpy as np

    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        low = np.minimum(low, (shingles[None, at : at + 1024] * factors[:, None] + terms[:, None]).min(axis=1))
    return (low >> np.uint64(32)).astype(np.uint32)


def hash_functions(n: int):
    import numpy as np

    numbers = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return numbers[:n] | np.uint64(1), numbers[n:]


def fewest_equal(n: int, threshold: float, miss: float) -> int:
    """The fewest equal values of n after which P(similarity >= threshold) is still `miss` or more.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper tail is that of a binomial.
    """
    for m in range(n + 1):
        tail = sum(comb(n + 1, i) * threshold**i * (1 - threshold) ** (n + 1 - i) for i in range(m + 1))
        if tail >= miss:
            return m
    return n + 1


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """docs: id, text, th. Gives id, th, n, node (null for an empty set) and the signature."""
    import numpy as np
    import pyarrow as pa

    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        factors, terms = hash_functions(BANDS * ROWS)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sizes, nodes, signs = [], [], []
                for text in part.column(1).to_pylist():
                    s = shingle_set(text, width)
                    sizes.append(len(s))
                    if len(s):
                        nodes.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
                        signs.append(signature(s, factors, terms).tobytes())
                    else:
                        nodes.append(None)
                        signs.append(None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(sizes, pa.int64()),
                        pa.array(nodes, pa.int64()),
                        pa.array(signs, pa.binary()),
                    ],
                    names=["id", "th", "n", "node", "sig"],
                )

    return docs.mapInArrow(run, f"id {kind}, th long, n long, node long, sig binary")


def band_keys(nodes: DataFrame) -> DataFrame:
    """(node, key): the keys of the bands, computed from the signatures wherever they are needed."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        band = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            if batch.num_rows:
                sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, BANDS * ROWS)
                x = np.tile(band, (len(sig), 1))
                for r in range(ROWS):
                    x = mixed(x * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS].astype(np.uint64))
                which = pa.array(np.repeat(np.arange(len(sig)), BANDS))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(which), pa.array(x.view(np.int64).ravel())], names=["node", "key"])

    return nodes.select("node", "sig").mapInArrow(run, "node long, key long")


def promising(pairs: DataFrame, nodes: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Pairs (a, b) whose signatures, compared batch by batch, leave a similarity of `threshold` possible."""
    import numpy as np

    total = BANDS * ROWS
    steps = [(n, fewest_equal(n, threshold, miss)) for n in range(BATCH, total + 1, BATCH)]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint32).reshape(-1, total) for c in (2, 3))
                alive, equal = np.arange(part.num_rows), np.zeros(part.num_rows, np.int64)
                for n, least in steps:
                    equal[alive] += (a[alive, n - BATCH : n] == b[alive, n - BATCH : n]).sum(axis=1)
                    alive = alive[equal[alive] >= least]
                yield part.select([0, 1]).take(alive)

    sig = nodes.select("node", "sig")
    joined = pairs.join(sig.withColumnsRenamed({"node": "b", "sig": "sb"}), "b")
    joined = joined.join(sig.withColumnsRenamed({"node": "a", "sig": "sa"}), "a").select("a", "b", "sa", "sb")
    return joined.mapInArrow(run, "a long, b long")


def full_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, shingles as bytes) for the wanted nodes, from the text of one document each."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [shingle_set(t, width).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], names=["node", "s"])

    chosen = nodes.join(wanted, "node", "left_semi").select("node", "id", "th")
    texts = docs.alias("d").join(
        chosen.alias("c"), F.expr("d.th = c.th AND d.id <=> c.id")
    )
    # repeated rows would give a node twice
    return texts.select("node", "text").mapInArrow(run, "node long, s binary").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union of their full sets."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part, keep = batch.slice(at, 250), []
                for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    sizes = len(x) + len(y)
                    near = 100 * min(len(x), len(y)) >= percent * max(len(x), len(y))
                    both = len(np.intersect1d(x, y, assume_unique=True)) if near else 0
                    keep.append(100 * both >= percent * (sizes - both))
                yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.withColumnsRenamed({"node": "b", "s": "sb"}), "b")
    joined = joined.join(sets.withColumnsRenamed({"node": "a", "s": "sa"}), "a").select("a", "b", "sa", "sb")
    return joined.mapInArrow(run, "a long, b long")


def rare_partners(sets: DataFrame, crowded: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Every pair of `crowded` (node, c) with different c that may reach the threshold: they share a rare shingle.

    Two sets of which one has x members share at least percent/100 * x, so they share one of the x - that + 1 members
    that come first in any common order; here the rarest come first.
    """
    import numpy as np
    import pyarrow as pa

    def spread(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                members = [np.frombuffer(s, np.int64) for s in part.column(2).to_pylist()]
                which = np.repeat(np.arange(len(members)), [len(m) for m in members])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(which)),
                        part.column(1).take(pa.array(which)),
                        pa.array(np.repeat([len(m) for m in members], [len(m) for m in members]), pa.int64()),
                        pa.array(np.concatenate(members) if members else np.empty(0, np.int64)),
                    ],
                    names=["node", "c", "n", "x"],
                )

    rows = sets.join(crowded, "node").select("node", "c", "s").mapInArrow(spread, "node long, c long, n long, x long")
    rows = scratch.save(rows, "crowd-rows")
    often = scratch.save(rows.groupBy("x").agg(F.count("*").alias("df")), "often")
    place = F.row_number().over(Window.partitionBy("node").orderBy("df", "x"))
    first = rows.join(often, "x").withColumn("place", place).select("node", "c", "n", "x", "place")
    first = scratch.save(first.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1), "crowd")
    scratch.drop("crowd-rows", "often")
    open_ = first.groupBy("x").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 != c1").select("x")
    first = first.join(scratch.save(open_, "open"), "x")
    a, b = (first.select(*[F.col(k).alias(k + s) for k in ("node", "c", "n", "place")], "x") for s in "12")
    # of the first member that two sets share, nothing before is shared: so much can follow, and so much is needed
    most = F.least(F.col("n1") - F.col("place1"), F.col("n2") - F.col("place2")) + 1
    pairs = a.join(b, "x").where(
        (F.col("node1") < F.col("node2"))
        & (F.col("c1") != F.col("c2"))
        & (100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2"))
        & ((100 + percent) * most >= percent * (F.col("n1") + F.col("n2")))
    )
    return pairs.select(F.col("node1").alias("a"), F.col("node2").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 75,
    miss: float = 1e-6,
    crowd: int = 16,
) -> DataFrame:
    """Link documents with 100 * intersection >= percent * union of their shingle sets, and follow the links.

    Returns id_col, text_hash, n_shingles, component_id (smallest reachable id, itself included) and kept (id = component_id).
    Equal sets are linked; a null, empty or blank text has no shingles and is linked with nothing. Rows with a null id
    take part but are never the smallest; a component of such rows only has a null component_id, and its rows are kept.
    Repeated rows come back repeatedly. Other columns are not read. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    scratch = Scratch(docs.sparkSession)
    rows = scratch.save(sketches(docs.select("id", "text", "th"), width), "sketches")
    nodes = rows.where("node IS NOT NULL").groupBy("node")
    nodes = nodes.agg(F.min(F.struct(F.col("id").isNull(), "id", "th")).alias("r"), F.first("sig").alias("sig"))
    nodes = scratch.save(nodes.select("node", "r.id", "r.th", "sig"), "nodes")
    # the signature of a node is kept once
    rows = scratch.save(rows.drop("sig"), "rows")
    scratch.drop("sketches")
    held = band_keys(nodes)
    threshold = percent / 100

    # First round: one partner each, the node that shares most keys with others (an original rather than an edited copy).
    # Aggregates by key are stored before they are joined by it: a join with exchanges of its own can split a full key.
    shared = scratch.save(held.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    held = scratch.save(held.join(shared, "key"), "held")
    scratch.drop("shared")
    fame = held.groupBy("node").agg(F.sum("n").alias("fame"))
    famous = held.join(fame, "node").groupBy("key").agg(F.max(F.struct("fame", "node")).alias("top"))
    famous = scratch.save(famous, "famous")
    first = held.join(famous, "key").where("node != top.node").groupBy("node").agg(F.max("top").alias("top"))
    first = first.select(F.least("node", "top.node").alias("a"), F.greatest("node", "top.node").alias("b")).distinct()
    first = scratch.save(promising(first, nodes, threshold, miss), "pairs")
    scratch.drop("famous")
    sets = full_sets(first.select(F.col("a").alias("node")).union(first.select("b")).distinct(), nodes, docs, width)
    links = scratch.save(confirmed(first, scratch.save(sets, "sets"), percent), "links")
    scratch.drop("pairs", "sets")
    roots = components(links)

    # Second round: what is not linked yet
    known = held.join(roots, "node", "left").select("node", "key", "n", F.coalesce("root", "node").alias("c"))
    mixed_keys = known.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1"))
    mixed_keys = scratch.save(mixed_keys.where("c0 != c1").select("key"), "mixed")
    known = scratch.save(known.join(mixed_keys, "key"), "known")
    scratch.drop("held", "mixed")
    few = known.where(F.col("n") <= crowd)
    x, y = (few.select("key", F.col("node").alias(n), F.col("c").alias("c" + n)) for n in "ab")
    pairs = x.join(y, "key").where("a < b AND ca != cb").select("a", "b").distinct()
    crowded = scratch.save(known.where(F.col("n") > crowd).select("node", "c").distinct(), "crowded")
    crowd_sets = scratch.save(full_sets(crowded.select("node"), nodes, docs, width), "crowd-sets")
    pairs = pairs.union(rare_partners(crowd_sets, crowded, percent, scratch)).distinct()
    second = scratch.save(promising(pairs, nodes, threshold, miss), "second")
    scratch.drop("known", "crowded", "crowd-sets", "crowd", "open")
    sets = full_sets(second.select(F.col("a").alias("node")).union(second.select("b")).distinct(), nodes, docs, width)
    second = scratch.save(confirmed(second, scratch.save(sets, "sets"), percent), "more")
    roots = components(links.union(second))
    scratch.drop("sets", "second", "links", "more")

    # Components carry the smallest id of their documents
    of = nodes.select("node", "id").join(roots, "node", "left").select("node", "id", F.coalesce("root", "node").alias("c"))
    of = scratch.save(of, "components")
    scratch.drop("nodes")
    least = scratch.save(of.groupBy("c").agg(F.min("id").alias("component_id")), "labels")
    of = of.join(least, "c").select("node", "component_id")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.join(of, "node", "left").select(
        F.col("id").alias(id_col),
        F.col("th").alias("text_hash"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
