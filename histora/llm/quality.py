"""Quality classifier: a factorisation machine over hashed words, structure statistics and text metadata (operator 4).

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)), so a text costs time linear in its features.

Features of a text: its distinct words, hashed, weighted by the square root of their frequency and scaled to length 1;
statistics of its structure, each as one of `BINS` steps; and its length as metadata. Ids, labels, language and source are no features.
The machine is fitted by Adagrad on at most `max_rows` labelled rows, chosen by a hash of their id.
"""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import ascii_words, fold, ship

BINS = 16
STATISTICS = (
    "words", "bytes per word", "upper case", "symbols", "digits", "repeated symbols", "distinct words",
    "most frequent word", "word repeated at once", "lone symbols", "distinct lines", "words per line", "other bytes",
)


class Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 60_000:
            self[word] = h
        return h


HASHES = Buckets()


def byte_kinds():
    """0 other, 1 lower, 2 upper, 3 digit, 4 white space, 5 symbol; bytes of other scripts are 0."""
    import numpy as np

    kinds = np.zeros(256, np.uint8)
    kinds[33:127] = 5
    kinds[97:123], kinds[65:91], kinds[48:58] = 1, 2, 3
    kinds[[32, 9, 10, 11, 12, 13]] = 4
    return kinds


def statistics(text: str, words: list[bytes], counts: dict[bytes, int]) -> list[float]:
    """Shares between 0 and 1, in the order of STATISTICS. Defined for empty texts too."""
    import numpy as np

    global KINDS
    if KINDS is None:
        KINDS = byte_kinds()
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kind = np.bincount(KINDS[data], minlength=6) if len(data) else np.zeros(6, int)
    n, seen = len(words), max(1, len(data) - int(kind[4]))
    symbol = KINDS[data[1:]] == 5 if len(data) > 1 else np.zeros(0, bool)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        np.log2(n + 1) / 20,
        seen / max(1, n) / 24,
        kind[2] / max(1, kind[1] + kind[2]),
        kind[5] / seen,
        kind[3] / seen,
        int((symbol & (data[1:] == data[:-1])).sum()) / seen,
        len(counts) / max(1, n),
        max(counts.values(), default=0) / max(1, n),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / max(1, n),
        sum(c for w, c in counts.items() if len(w) == 1 and not w.isalnum()) / max(1, n),
        len(set(lines)) / max(1, len(lines)),
        np.log2(n / max(1, len(lines)) + 1) / 12,
        kind[0] / seen,
    ]


KINDS = None


def features(text: str | None, buckets: int):
    """(indices, values): structure steps first, then words. A null text is an empty one."""
    import numpy as np

    text = text or ""
    words = ascii_words(text)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    # the square root gives small shares steps of their own
    steps = np.minimum((np.sqrt(np.clip(statistics(text, words, counts), 0, 1)) * BINS).astype(np.int64), BINS - 1)
    fixed = np.arange(len(STATISTICS)) * BINS + steps
    if not words:
        return fixed, np.ones(len(fixed), np.float32)
    hashed = np.fromiter(map(HASHES.__getitem__, counts), np.uint64, len(counts)) % np.uint64(buckets)
    weights = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)) / len(words))
    index = np.concatenate([fixed, len(STATISTICS) * BINS + hashed.astype(np.int64)])
    return index, np.concatenate([np.ones(len(fixed)), weights]).astype(np.float32)


def forward(model, index, value, starts):
    """Logits of texts whose features lie in [start, next start), with the sums needed for the gradient."""
    import numpy as np

    w0, w, v = model
    x = value[:, None] * v[index]
    sums = np.add.reduceat(x, starts, axis=0)
    pairs = 0.5 * (sums**2 - np.add.reduceat(x**2, starts, axis=0)).sum(axis=1)
    return w0 + np.add.reduceat(value * w[index], starts) + pairs, sums, x


def fit(rows: list[tuple], labels: list[int], buckets: int, rank: int, visits: int = 60_000, seed: int = 7):
    """Adagrad on the logistic loss, in small batches; `visits` row visits whatever the number of rows, 40 passes at most."""
    import numpy as np

    size = len(STATISTICS) * BINS + buckets
    random = np.random.default_rng(seed)
    share = (sum(labels) + 1) / (len(labels) + 2)
    model = [np.log(share / (1 - share)), np.zeros(size, np.float32), random.normal(0, 0.02, (size, rank)).astype(np.float32)]
    if not rows:
        return model
    y = np.array(labels, np.float32)
    g0, gw, gv = 1.0, np.full(size, 1.0, np.float32), np.full((size, rank), 1.0, np.float32)
    rate, decay, batch = 0.15, 1e-5, 32
    for _ in range(max(1, min(40, visits // len(rows)))):
        order = random.permutation(len(rows))
        for at in range(0, len(rows), batch):
            part = order[at : at + batch]
            index = np.concatenate([rows[i][0] for i in part])
            value = np.concatenate([rows[i][1] for i in part])
            sizes = [len(rows[i][0]) for i in part]
            starts = np.cumsum([0, *sizes[:-1]])
            logit, sums, x = forward(model, index, value, starts)
            error = (1 / (1 + np.exp(-logit)) - y[part]).astype(np.float32)
            each = np.repeat(error, sizes) * value
            grad_v = each[:, None] * (np.repeat(sums, sizes, axis=0) - x)
            known, where = np.unique(index, return_inverse=True)
            by = np.argsort(where, kind="stable")
            first = np.searchsorted(where[by], np.arange(len(known)))
            dw = np.add.reduceat(each[by], first) + decay * model[1][known]
            dv = np.add.reduceat(grad_v[by], first, axis=0) + decay * model[2][known]
            gw[known] += dw**2
            gv[known] += dv**2
            g0 += float(error.sum()) ** 2
            model[1][known] -= rate * dw / np.sqrt(gw[known])
            model[2][known] -= rate * dv / np.sqrt(gv[known])
            model[0] -= rate * float(error.sum()) / np.sqrt(g0)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str, buckets: int, rank: int, max_rows: int):
    """A model from labelled rows whose id is not held out. docs: id, text; labels: id and the label."""
    import numpy as np
    import pyarrow as pa

    chosen = labels.where(F.col(label).isNotNull() & (fold("id", 5) != 0)).select("id", F.col(label).cast("int").alias("y"))
    chosen = chosen.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(max_rows)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [features(t, buckets) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(1),
                        part.column(2),
                        pa.array([i.astype(np.int32).tobytes() for i, _ in found], pa.binary()),
                        pa.array([v.tobytes() for _, v in found], pa.binary()),
                    ],
                    names=["id", "y", "i", "v"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    rows = docs.join(chosen, "id").select("text", "id", "y").mapInArrow(run, f"id {kind}, y int, i binary, v binary")
    # repeated rows of one id count once
    rows = sorted({r.id: r for r in rows.toLocalIterator()}.values(), key=lambda r: r.id)
    data = [(np.frombuffer(r.i, np.int32).astype(np.int64), np.frombuffer(r.v, np.float32)) for r in rows]
    return fit(data, [r.y for r in rows], buckets, rank)


def scored(docs: DataFrame, model, text_col: str, score_col: str) -> DataFrame:
    """docs with a score between 0 and 1 in one more column."""
    import numpy as np

    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    buckets = len(model[1]) - len(STATISTICS) * BINS

    def run(texts: pd.Series) -> pd.Series:
        out = []
        for at in range(0, len(texts), 200):
            found = [features(t, buckets) for t in texts.iloc[at : at + 200]]
            starts = np.cumsum([0, *(len(i) for i, _ in found[:-1])])
            index, value = np.concatenate([i for i, _ in found]), np.concatenate([v for _, v in found])
            out.append(forward(shared.value, index, value, starts)[0])
        logit = np.concatenate(out) if out else np.empty(0)
        return pd.Series(1 / (1 + np.exp(-np.clip(logit, -30, 30))), dtype="float64")

    return docs.withColumn(score_col, F.pandas_udf(run, "double")(F.col(text_col)))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.3,
    buckets: int = 1 << 15,
    rank: int = 8,
    max_rows: int = 6000,
) -> DataFrame:
    """Score every text; learn from at most `max_rows` labelled rows with crc32(id) mod 5 other than 0.

    Returns id_col, held_out, score (0 to 1) and predicted (score >= threshold). Null and empty texts are scored alike.
    Rows with a null id are scored, and held out; null labels teach nothing; without any label every score comes from the
    prior. Repeated rows come back repeatedly; other columns are not read; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model = train(docs, labels.select(F.col(id_col).alias("id"), label), label, buckets, rank, max_rows)
    found = scored(docs, model, "text", "score").select("id", "score")
    return found.select(
        F.col("id").alias(id_col),
        F.coalesce(fold("id", 5) == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
