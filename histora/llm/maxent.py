"""Language-model scores from a hashed maximum-entropy model with class-factored softmax (operator 10).

P(word | words before) = P(class | features) * P(word | class, features).

Classes: the end; the most frequent words, each alone; the other words of the vocabulary by rank and last letters; and all
rarer words. The class is a softmax over features: a constant, the word before (n-gram), the word before that
(skip), and both together, each hashed to a row of weights. Within a class the words of the vocabulary are the leaves of a Huffman tree.
Each fork is a logistic function of the same three features, by word and not by bucket; fork and feature are hashed to one of
`slots` weights, 2 to 4 for each word. A fork starts at the counts of its sides, so that a word starts at its share of the class. Words
beyond the vocabulary have their share of the rare class. Unseen words are one event of it, with as much mass as all words seen once.

The vocabulary holds the `vocabulary` most frequent words seen twice or more; it and the weights are all that is
broadcast. Counts of rarer words are joined. The weights start at the log frequency of the classes and are trained
in rounds, at the forks as well, which together visit every training text once: in a round each task updates its own copy by gradient steps
over small batches, and the changes, weighted by how often a task has seen a row, are added up by Spark.

Every text is turned into codes once; training and scoring read these. A task gives out a change as large as the model, so their
number follows the training tokens (TASK_TOKENS) and not the files of the input: the texts of a round are dealt to the tasks by a
hash of id and text and read in that order. Scores therefore don't depend on how the input is split.
"""

from __future__ import annotations

import zlib

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import Scratch, fold, ship

SINGLE, GROUPS, BANDS = 12, 6, (500, 8000)
CLASSES = 1 + SINGLE + GROUPS * (len(BANDS) + 1) + 1
RARE = CLASSES - 1
OWN, NEAR, PAIRS = 3000, 4096, 8192
#: Rows of weights: the constant, the word before, the word before that, both
ROWS = 1 + NEAR + NEAR + PAIRS
FIRST = NEAR - 1
#: Tokens that a task of a training round learns from, and the most tasks a round has; beyond it tasks have more tokens
TASK_TOKENS, TASKS = 3_000_000, 4096
#: Runs of rows up to this length are added up row by row
SHORT = 4
END = b"\n"
"""No word can be a line break."""


def word_lists(texts):
    """Lists of the words of an Arrow array of texts, as `ascii_words` gives them but as an Arrow array; white space that begins or ends a text
    gives an empty word as well. Null texts are empty."""
    import pyarrow.compute as pc

    return pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))


def hashes_and_groups(words):
    """Hash and letter group, by its last bytes, of each word of an Arrow array."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    words = words.cast(pa.large_binary())
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))
    hashes ^= np.uint64(1 << 63)
    ends = pc.binary_slice(words, -2).dictionary_encode()
    groups = np.array([zlib.crc32(x) % GROUPS for x in ends.dictionary.to_pylist()], np.int32)
    return hashes.view(np.int64), groups[ends.indices.to_numpy()]


class Vocabulary:
    """The words of the model by rank, with class, share of the class and feature bucket; rarer words are beyond it.

    Codes: 0 the end, 1 + rank a word, then one code for each letter group of the rare words.
    """

    def __init__(self, hashes, groups, counts, ends: int, total: int, rare_count: int, once: int):
        """Words without the end, most frequent first; counts in the training texts. `once`: rare words seen once."""
        import numpy as np

        n = len(hashes)
        order = np.argsort(hashes)
        self.sorted, self.rank = hashes[order], order
        rank = np.arange(n)
        band = np.searchsorted(BANDS, rank, side="right")
        cls = np.where(rank < SINGLE, 1 + rank, 1 + SINGLE + band * GROUPS + groups)
        self.classes = np.concatenate([[0], cls, np.full(GROUPS, RARE)]).astype(np.int64)
        self.counts = np.concatenate([[ends], counts, np.zeros(GROUPS, np.int64)]).astype(np.int64)
        sums = np.bincount(self.classes, weights=self.counts, minlength=CLASSES)
        self.rare_total, self.unseen = rare_count + max(1, once), max(1, once)
        self.share = np.log(np.maximum(self.counts, 1) / np.maximum(sums[self.classes], 1))
        self.share[n + 1 :] = 0.0  # rare words: joined
        mixed = (hashes.view(np.uint64) >> np.uint64(20)) % np.uint64(NEAR - OWN - GROUPS - 1)
        own = np.where(rank < OWN, rank, OWN + mixed.astype(np.int64))
        self.buckets = np.concatenate([[FIRST], own, FIRST - 1 - np.arange(GROUPS)]).astype(np.int64)
        sums[RARE] = max(1, rare_count)
        # classes without words get next to nothing
        self.start = np.where(sums > 0, np.log(np.maximum(sums, 1) / max(1, total)), -30).astype(np.float32)
        self.forks = Forks(self.classes[: n + 1], np.maximum(self.counts[: n + 1], 1), len(self.classes))

    def codes(self, hashes, groups):
        """Codes of words."""
        import numpy as np

        n = len(self.sorted)
        if not n:
            return 1 + groups
        at = np.minimum(np.searchsorted(self.sorted, hashes), n - 1)
        return np.where(self.sorted[at] == hashes, 1 + self.rank[at], n + 1 + groups).astype(np.int32)

    def encode(self, texts):
        """Of an Arrow array of texts: codes of all their words, the place in them where each text begins (and the last ends), and for the
        rare words of each text: the text, the hash and how often the word occurs in it, by text."""
        import numpy as np

        words = word_lists(texts)
        coded = words.flatten().dictionary_encode()
        hashes, groups = hashes_and_groups(coded.dictionary)
        ids, bounds = coded.indices.to_numpy(), words.offsets.to_numpy() - words.offsets[0].as_py()
        empty = coded.dictionary.index("").as_py()
        if empty >= 0:
            kept = ids != empty
            ids, bounds = ids[kept], np.concatenate([[0], np.cumsum(kept)])[bounds]
        codes = self.codes(hashes, groups)[ids]
        rare = np.flatnonzero(codes > len(self.sorted))
        text = np.searchsorted(bounds, rare, side="right") - 1
        pairs, times = np.unique(text * len(hashes) + ids[rare], return_counts=True)
        return codes, bounds, pairs // max(1, len(hashes)), hashes[pairs % max(1, len(hashes))], times


def huffman(counts: list[int]):
    """Parent and side of every leaf, then of every fork, of a Huffman tree; counts in descending order. The root is last."""
    n = len(counts)
    weights, parent, side = [*counts, *[0] * (n - 1)], [-1] * (2 * n - 1), [0] * (2 * n - 1)
    leaf, fork = n - 1, n  # the lightest ones not yet joined
    for new in range(n, 2 * n - 1):
        for s in (0, 1):
            if leaf >= 0 and (fork >= new or weights[leaf] <= weights[fork]):
                x, leaf = leaf, leaf - 1
            else:
                x, fork = fork, fork + 1
            parent[x], side[x] = new, s
            weights[new] += weights[x]
    return weights, parent, side


class Forks:
    """The trees of all classes. A word's way is the forks from its leaf up, each with the side it lies on."""

    def __init__(self, classes, counts, codes: int):
        """classes and counts by code, most frequent words first; `codes`: all codes, the others have no way."""
        import numpy as np

        parents, sides, starts, leaves = [], [], [], np.full(len(classes), -1, np.int64)
        leaf_sides, base = np.zeros(len(classes), np.int64), 0
        order = np.lexsort((-counts, classes))
        for members in np.split(order, np.flatnonzero(np.diff(classes[order])) + 1):
            n = len(members)
            if n < 2:
                continue
            weights, parent, side = (np.array(x) for x in huffman(counts[members].tolist()))
            left = np.zeros(n - 1)
            of_left = np.flatnonzero((side == 0) & (parent >= 0))
            left[parent[of_left] - n] = weights[of_left]
            starts.append(np.log((weights[n:] - left) / left))
            above = np.where(parent >= 0, parent - n + base, -1)
            leaves[members], leaf_sides[members] = above[:n], side[:n]
            parents.append(above[n:])
            sides.append(side[n:])
            base += n - 1
        none = np.empty(0, np.int64)
        parents, sides = np.concatenate([*parents, none]), np.concatenate([*sides, none])
        self.start = np.concatenate([*starts, none]).astype(np.float32)
        code, at, side, ways = np.flatnonzero(leaves >= 0), leaves[leaves >= 0], leaf_sides[leaves >= 0], []
        while len(code):
            ways.append((code, 2 * at + side))
            at, side = parents[at], sides[at]
            code, at, side = code[at >= 0], at[at >= 0], side[at >= 0]
        code = np.concatenate([*[c for c, _ in ways], none])
        self.ways = np.concatenate([*[w for _, w in ways], none])[np.argsort(code, kind="stable")].astype(np.int32)
        self.ends = np.cumsum(np.bincount(code, minlength=codes))
        self.lengths = np.diff(self.ends, prepend=0)
        self.slots = 1 << max(10, (2 * len(classes) - 3).bit_length())

    def places(self, codes, contexts):
        """Of all forks on the ways of the codes: the token, the side, the logit to start with, and the slots of its features."""
        import numpy as np

        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        token = np.repeat(np.arange(len(codes)), lengths)
        at = np.repeat(self.ends[codes] - ends, lengths)
        at += np.arange(len(token))
        way = np.take(self.ways, at)
        fork = way >> 1
        mixed = np.repeat(contexts, lengths, axis=1)
        mixed ^= fork.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed >>= np.uint64(65 - self.slots.bit_length())
        return token, way & 1, np.take(self.start, fork), mixed.view(np.int64)

    def log_probability(self, weights, codes, contexts):
        """log P(word | class, features) of each place; 0 for words without a way."""
        import numpy as np

        token, side, z, slots = self.places(codes, contexts)
        z = z + np.take(weights, slots).sum(axis=0)
        np.negative(z, out=z, where=side == 1)
        # -log(1 + exp(z)) for any z; logaddexp works one number at a time
        return np.bincount(token, weights=-(np.maximum(z, 0) + np.log(1 + np.exp(-np.abs(z)))), minlength=len(codes))

    def descend(self, weights, squares, sums, codes, contexts, rate: float = 0.2, batch: int = 4096) -> None:
        """A gradient step on each batch of tokens, with Adagrad's step sizes per slot. `sums` is zero before and after."""
        import numpy as np

        # a slot's weight and square lie side by side, so that they are read and written at once
        both = np.stack([weights, squares], axis=1).view(np.complex64).ravel()
        for b in range(0, len(codes), batch):
            _, side, z, slots = self.places(codes[b : b + batch], contexts[:, b : b + batch])
            flat = slots.ravel()
            found = np.take(both, flat)
            weight, square = found.real, found.imag
            z = z + weight.reshape(slots.shape).sum(axis=0)
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - side.astype(np.float32)
            np.add.at(sums, flat, np.tile(g, len(slots)))
            change = np.take(sums, flat)
            if 8 * len(flat) < len(sums):
                sums[flat] = 0
            else:
                sums.fill(0)
            square += change * change
            change *= rate
            change /= np.sqrt(square)
            weight -= change
            # places with the same slot write the same values
            both[flat] = found
        weights[:], squares[:] = both.real, both.imag


def contexts(codes, starts):
    """Hashes of the word before, the word before that, and both, for every token; before a text is its end."""
    import numpy as np

    both = np.zeros((3, len(codes)), np.uint64)
    both[0, 1:] = codes[:-1]
    both[0, starts] = 0
    both[1, 1:] = both[0, :-1]
    both[1, starts] = 0
    both[2] = both[0] * np.uint64(0xA24BAED4963EE407) + both[1] * np.uint64(0x9FB21C651E98DF25) + np.uint64(3)
    both[:2] += np.array([[1 << 40], [1 << 41]], np.uint64)
    both *= np.uint64(0xC2B2AE3D27D4EB4F)
    return both ^ (both >> np.uint64(29))


def features(vocabulary: Vocabulary, codes: list):
    """Rows of weights for every token of the texts (each with its end), and the tokens' codes."""
    import numpy as np

    all_codes = np.concatenate([x for c in codes for x in (c, [0])]).astype(np.int64)
    sizes = np.array([len(c) + 1 for c in codes])
    starts = np.cumsum(np.concatenate([[0], sizes[:-1]]))
    bucket = vocabulary.buckets[all_codes]
    one = np.empty_like(bucket)
    one[1:] = bucket[:-1]
    one[starts] = FIRST
    two = np.empty_like(bucket)
    two[1:] = one[:-1]
    two[starts] = FIRST
    pair = (one * 40503 + two * 30011 + (one * two >> 3)) % PAIRS
    return all_codes, starts, (1 + one, 1 + NEAR + two, 1 + 2 * NEAR + pair)


def exponentials(weights, rows):
    """exp of the logits of every class; divided by their sum they are the probabilities."""
    import numpy as np

    z = np.take(weights, rows[0], axis=0)
    z += np.take(weights, rows[1], axis=0)
    z += np.take(weights, rows[2], axis=0)
    z += weights[0]
    # far beyond what training reaches, and safe for exp
    return np.exp(np.clip(z, -60, 60, out=z), out=z)


def log_probability(weights, rows, classes):
    """log P(class) of each place."""
    import numpy as np

    e = exponentials(weights, rows)
    return np.log(e[np.arange(len(classes)), classes] / e.sum(axis=1))


def run_sums(values, first, sizes):
    """Sums of the runs of rows that start at `first`. Most runs are short: these are added up row by row, all runs at once."""
    import numpy as np

    found = np.take(values, first, axis=0)
    at = np.flatnonzero((sizes > 1) & (sizes <= SHORT))
    rest = np.take(values, first[at] + 1, axis=0)
    for k in range(2, SHORT):
        more = np.flatnonzero(sizes[at] > k)
        rest[more] += np.take(values, first[at[more]] + k, axis=0)
    found[at] += rest
    at = np.flatnonzero(sizes > SHORT)
    if len(at):
        held = np.take(values, np.flatnonzero(np.repeat(sizes > SHORT, sizes)), axis=0)
        ends = np.cumsum(sizes[at])
        found[at] = np.add.reduceat(np.ascontiguousarray(held.T), ends - sizes[at], axis=1).T
    return found


def descend(weights, squares, seen, rows, classes, rate: float = 0.6) -> None:
    """One gradient step on a batch, with Adagrad's step sizes per row; `seen` counts the tokens of each row."""
    import numpy as np

    g = exponentials(weights, rows)
    g /= g.sum(axis=1, keepdims=True)
    n = len(classes)
    g[np.arange(n), classes] -= 1
    change = g.sum(axis=0)
    squares[0] += change @ change
    weights[0] -= rate / np.sqrt(squares[0]) * change
    seen[0] += n
    for r in rows:
        order = np.argsort(r.astype(np.uint16), kind="stable")
        sorted_rows = r[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
        known, sizes = sorted_rows[first], np.diff(np.append(first, n))
        change = run_sums(np.take(g, order, axis=0), first, sizes)
        squares[known] += np.einsum("ij,ij->i", change, change)
        change *= (rate / np.sqrt(squares[known]))[:, None]
        weights[known] -= change
        seen[known] += sizes


def train(coded: DataFrame, vocabulary, start, slots: int, rounds: int, batch: int, tasks: int):
    """Weights of classes and of forks after `rounds` rounds over the training texts (columns: codes, part: 0 to rounds - 1, and `deal`,
    by which the texts of a round are dealt to `tasks` tasks)."""
    import numpy as np
    import pyarrow as pa

    spark = coded.sparkSession
    weights = np.zeros((ROWS, CLASSES), np.float32)
    weights[0] = start
    forks = np.zeros(slots, np.float32)
    names = [f"d{i}" for i in range(CLASSES)]
    schema = "row int, n double, " + ", ".join(f"{c} float" for c in names)

    for part in range(rounds):
        shared = spark.sparkContext.broadcast((weights, forks))

        def run(batches, shared=shared):
            own, inner = (x.copy() for x in shared.value)
            inner_squares, sums = np.ones(slots, np.float32), np.zeros(slots, np.float32)
            squares, seen = np.ones(ROWS, np.float32), np.zeros(ROWS)
            voc, held, size = vocabulary.value, [], 0

            def learn():
                all_codes, starts, rows = features(voc, held)
                classes = voc.classes[all_codes]
                voc.forks.descend(inner, inner_squares, sums, all_codes, contexts(all_codes, starts), batch=batch)
                for b in range(0, len(classes), batch):
                    descend(own, squares, seen, [r[b : b + batch] for r in rows], classes[b : b + batch])

            # batches of Arrow depend on settings; those of the steps don't
            for found in batches:
                for codes in found.column(0).to_pylist():
                    held.append(np.frombuffer(codes, np.int32))
                    size += len(held[-1]) + 1
                    if size >= 64 * batch:
                        learn()
                        held, size = [], 0
            if held:
                learn()
            hit = np.flatnonzero(seen)
            change = ((own - shared.value[0])[hit] * seen[hit][:, None]).astype(np.float32)
            columns = [pa.array(hit.astype(np.int32)), pa.array(seen[hit]), *(pa.array(c) for c in np.ascontiguousarray(change.T))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n", *names])
            # slots in rows of CLASSES: the changes times the sum of squared gradients, then that sum
            inner_squares -= 1
            inner -= shared.value[1]
            inner *= inner_squares
            pairs = np.stack([inner.reshape(-1, CLASSES), inner_squares.reshape(-1, CLASSES)], axis=1).reshape(-1, CLASSES)
            hit = np.flatnonzero(pairs.any(axis=1))
            columns = [pa.array((ROWS + hit).astype(np.int32)), pa.array(np.ones(len(hit)))]
            columns += [pa.array(np.ascontiguousarray(c)) for c in pairs[hit].T]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n", *names])

        # copies of one row are counted first and dealt out one by one, so no task gets all of them
        copies = coded.where(F.col("part") == part).groupBy("deal", "codes").agg(F.count("*").alias("n"))
        copies = copies.select("codes", F.explode(F.transform(F.sequence(F.lit(1), "n"), lambda i: F.xxhash64("deal", i))).alias("deal"))
        # coalesce holds the number of tasks also where a session deals out to more partitions than asked for
        dealt = copies.repartition(tasks, "deal").coalesce(tasks).sortWithinPartitions("deal", "codes")
        changes = dealt.select("codes").mapInArrow(run, schema)
        changes = changes.groupBy("row").agg(*[(F.sum(c) / F.sum("n")).alias(c) for c in names]).toArrow()
        if changes.num_rows:
            row = changes.column("row").to_numpy()
            found = np.column_stack([changes.column(c).to_numpy() for c in names])
            outer = row < ROWS
            weights = weights.copy()
            weights[row[outer]] += found[outer].astype(np.float32)
            pairs = np.zeros((2 * slots // CLASSES, CLASSES))
            pairs[row[~outer] - ROWS] = found[~outer]
            change, seen = pairs[0::2].ravel(), pairs[1::2].ravel()
            forks = forks + np.divide(change, seen, out=np.zeros(slots), where=seen > 0).astype(np.float32)
        shared.unpersist()
    return weights, forks


def count_words(texts: DataFrame) -> DataFrame:
    """(h, g, c): hash, letter group and number of each word of the texts."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 3000):
                words, counts = word_lists(batch.column(0).slice(at, 3000)).flatten().value_counts().flatten()
                kept = pc.not_equal(words, "")
                hashes, groups = hashes_and_groups(words.filter(kept))
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(groups), counts.filter(kept)], names=["h", "g", "c"])

    counted = texts.select("text").mapInArrow(run, "h long, g int, c long")
    return counted.groupBy("h").agg(F.max("g").alias("g"), F.sum("c").alias("c"))


def maxent_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: int = 1 << 18,
    rounds: int = 4,
    batch: int = 4096,
) -> DataFrame:
    """log10 probability of every text; learn from all texts with crc32(id) mod 7 other than 2.

    Returns id_col, held_out, n_tokens (words and the end), n_known (of them, in the training texts), train_tokens, base_score
    (add-one unigram) and score. Null, empty and blank texts are only the end. Rows with a null id are scored, and held
    out. Repeated rows come back repeatedly, and teach repeatedly. How the input is split into files changes no score. Without training texts base_score is 0 and score
    comes from the starting weights. Other columns are not read; an empty table gives no rows.
    """
    import numpy as np
    import pyarrow as pa

    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    teaching = docs.where(fold("id", 7) != 2)
    scratch = Scratch(spark)
    counts = scratch.save(count_words(teaching), "word-counts")
    ends = teaching.count()
    words, types, once = counts.agg(F.sum("c"), F.count("*"), F.count(F.when(F.col("c") == 1, 1))).first()
    total, types = (words or 0) + ends, types + (ends > 0)

    top = counts.where("c >= 2").orderBy(F.desc("c"), "h").limit(vocabulary).toArrow()
    held = [top.column(c).to_numpy() for c in ("h", "g", "c")]
    rare = (words or 0) - int(held[2].sum())
    own = Vocabulary(held[0], held[1], held[2], ends, total, rare, once)
    shared = spark.sparkContext.broadcast(own)
    size, unseen, rare_total = len(held[0]), own.unseen, own.rare_total
    kind = docs.schema["id"].dataType.simpleString()

    def encode(batches):
        voc = shared.value
        for texts in batches:
            for at in range(0, texts.num_rows, 1000):
                part = texts.slice(at, 1000)
                codes, bounds, text, words, times = voc.encode(part.column(1))
                # codes of a text as bytes, and lists of its rare words, over arrays that hold those of all texts
                coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [None, *map(pa.py_buffer, (4 * bounds.astype(np.int64), codes))])
                lists = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        part.column(3),
                        coded.cast(pa.binary()),
                        pa.ListArray.from_arrays(lists, words),
                        pa.ListArray.from_arrays(lists, times),
                    ],
                    names=["id", "part", "deal", "codes", "words", "times"],
                )

    teaches = F.coalesce(fold("id", 7) != 2, F.lit(False))
    part = F.when(teaches, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(rounds)))
    dealt = docs.select("id", "text", part.cast("int").alias("part"), F.xxhash64("id", "text").alias("deal"))
    coded = scratch.save(dealt.mapInArrow(encode, f"id {kind}, part int, deal long, codes binary, words array<long>, times array<long>"), "coded")
    tasks = min(TASKS, max(1, -(-total // (rounds * TASK_TOKENS))))
    weights = spark.sparkContext.broadcast(train(coded, shared, own.start, own.forks.slots, rounds, batch, tasks))

    def run(batches):
        from pyspark import TaskContext

        key = TaskContext.get().partitionId() << 40
        voc, (w, inner) = shared.value, weights.value
        base = np.log10(voc.counts + 1.0)
        for found in batches:
            for at in range(0, found.num_rows, 200):
                part = found.slice(at, 200)
                codes = [np.frombuffer(c, np.int32) for c in part.column(1).to_pylist()]
                all_codes, starts, rows = features(voc, codes)
                classes, before = voc.classes[all_codes], contexts(all_codes, starts)
                p = np.empty(len(classes))
                for b in range(0, len(classes), 4096):
                    p[b : b + 4096] = log_probability(w, [r[b : b + 4096] for r in rows], classes[b : b + 4096])
                    p[b : b + 4096] += voc.forks.log_probability(inner, all_codes[b : b + 4096], before[:, b : b + 4096])
                n = len(codes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(key, key + n)),
                        part.column(0),
                        pa.array([len(x) + 1 for x in codes], pa.int64()),
                        pa.array(np.add.reduceat((voc.counts[all_codes] > 0).astype(np.int64), starts)),
                        pa.array(np.add.reduceat(base[all_codes], starts)),
                        pa.array(np.add.reduceat(p, starts) / np.log(10)),
                        part.column(2),
                        part.column(3),
                    ],
                    names=["k", "id", "n_tokens", "n_known", "base", "score", "words", "times"],
                )
                key += n

    scored = coded.select("id", "codes", "words", "times").mapInArrow(run, f"k long, id {kind}, n_tokens long, n_known long, base double, score double, words array<long>, times array<long>")
    scored = scratch.save(scored, "scored")
    scratch.drop("coded")
    listed = scored.select("k", F.explode(F.arrays_zip("words", "times")).alias("w")).select("k", F.col("w.words").alias("h"), F.col("w.times").alias("n"))
    c = F.coalesce("c", F.lit(0))
    listed = listed.join(counts.select("h", "c"), "h", "left").groupBy("k").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * F.log10(c + 1)).alias("rare_base"),
        F.sum(F.col("n") * F.log10(F.when(c > 0, c).otherwise(unseen) / F.lit(float(rare_total)))).alias("rare_score"),
    )
    zero = lambda name: F.coalesce(name, F.lit(0))
    return scored.drop("words", "times").join(listed, "k", "left").select(
        F.col("id").alias(id_col),
        F.coalesce(fold("id", 7) == 2, F.lit(True)).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + zero("rare_known")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("rare_base") - F.col("n_tokens") * F.lit(float(np.log10(total + types + 1)))).alias("base_score"),
        (F.col("score") + zero("rare_score")).alias("score"),
    )
