"""Toxicity by class-conditional Kneser-Ney models (operator 7).

Each class, toxic and ordinary, has a Kneser-Ney model over the letters of a word, each letter given the ORDER - 1 before it
(the word's start fills up). Both classes back off to the same continuation counts of the next lower order,
counted over both classes, so a rare expression that one class has not seen is not held against it: where
neither has the gram, what the models still differ by is only the mass they leave to unseen letters.

Per word, the log-likelihoods of both models are compared. A text's figures are divided by its number of words or by a fixed
one: the mean difference over all words, over the most toxic window of `WINDOW` words and over the `TOP` most toxic words, and
the share of words above `STRONG`. Their number, which tells more in a short text, and the text's length go in as logarithms.
A logistic function of all these is the score. It is fitted on texts that the compared models have not seen.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import fold, saved, ship

ORDER, DISCOUNT = 5, 0.75
WINDOW, TOP, STRONG = 8, 3, 3.5
START, END = "\x02", "\x03"
FIGURES = ["mean", "window", "top", "strong", "length", "many", "more"]

_AROUND = re.compile(r"^[\W_]+|[\W_]+$")


def words_of(text: str | None) -> list[str]:
    """Lower-cased words without the signs around them; what is only signs is no word."""
    words = [w if w.isalnum() else _AROUND.sub("", w) for w in (text or "").lower().split()]
    return [w for w in words if w]


def grams_of(word: str) -> list[str]:
    padded = START * (ORDER - 1) + word + END
    return [padded[i : i + ORDER] for i in range(len(word) + 1)]


def lower_order(grams: list[str], counts):
    """P(last letter | letters before) of every gram, by interpolated Kneser-Ney over its own and lower orders."""
    import numpy as np

    t = pd.DataFrame({"g": grams, "n": counts})
    if not len(t) or not t.g.iloc[0]:
        return np.full(len(t), 1.0)
    t["h"], t["low"] = t.g.str[:-1], t.g.str[1:]
    total, types = t.groupby("h").n.transform("sum"), t.groupby("h").n.transform("size")
    own = np.maximum(t.n - DISCOUNT, 0) / total
    if len(t.g.iloc[0]) == 1:
        back = np.full(len(t), 1 / (len(t) + 1))
    else:
        follows = t.groupby("low").size()
        back = t.low.map(pd.Series(lower_order(follows.index.tolist(), follows.to_numpy()), follows.index)).to_numpy()
    return (own + DISCOUNT * types / total * back).to_numpy()


class Model:
    """Log-likelihood ratios of known grams, and of the mass that known contexts leave."""

    def __init__(self, grams: list[str], shared, counts):
        """shared: P of each gram's last letter in the next lower order; counts: ordinary, toxic."""
        import numpy as np

        t = pd.DataFrame({"g": pd.Series(grams, dtype="object"), "shared": shared, "a": counts[0], "b": counts[1]})
        t["h"] = t.g.str[:-1]
        p, backs = [], []
        for c in "ab":
            total = t.groupby("h")[c].transform("sum")
            seen = t[c].gt(0).groupby(t.h).transform("sum")
            back = np.where(total > 0, DISCOUNT * seen / np.maximum(total, 1), 1.0)
            p.append(np.where(total > 0, np.maximum(t[c] - DISCOUNT, 0) / np.maximum(total, 1), 0) + back * t.shared)
            backs.append(back)
        self.grams = dict(zip(t.g, np.log(p[1] / p[0]).round(5).tolist(), strict=True))
        self.contexts = dict(zip(t.h, np.log(backs[1] / backs[0]).round(5).tolist(), strict=True))
        self.words: dict[str, float] = {}

    def ratio(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            grams, contexts = self.grams, self.contexts
            found = 0.0
            for g in grams_of(word):
                r = grams.get(g)
                found += contexts.get(g[:-1], 0.0) if r is None else r
            if len(self.words) < 300_000:
                self.words[word] = found
        return found

    def figures(self, texts: list[str | None]):
        """FIGURES of each text; zeros for a text without words."""
        import numpy as np

        out = np.zeros((len(texts), len(FIGURES)))
        for i, text in enumerate(texts):
            r = np.array([self.ratio(w) for w in words_of(text)])
            n = len(r)
            if not n:
                continue
            sums = np.concatenate([[0.0], np.cumsum(r)])
            span = min(WINDOW, n)
            top = min(TOP, n)
            out[i] = (
                sums[-1] / n,
                (sums[span:] - sums[:-span]).max() / WINDOW,
                np.partition(r, n - top)[n - top :].sum() / TOP,
                np.sqrt((r > STRONG).mean()),
                np.log(n),
                np.log1p((r > STRONG).sum()),
                np.log1p((r > STRONG).sum()) ** 2,
            )
        return out


def logistic(x, y, steps: int = 60, ridge: float = 0.05):
    """Newton's method on scaled figures. Gives the weights and the constant for unscaled ones."""
    import numpy as np

    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        w -= np.clip(np.linalg.solve(h, z.T @ (p - y) + ridge * w), -3, 3)
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def count_grams(rows: DataFrame) -> DataFrame:
    """rows: text, part (half * 2 + label). Counts (g, n0 ... n3) of the grams of all words."""
    import pyarrow as pa

    def run(batches):
        from collections import Counter

        for batch in batches:
            counts: Counter[tuple[str, int]] = Counter()
            for text, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in Counter(words_of(text)).items():
                    for g in grams_of(word):
                        counts[g, part] += n
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g for g, _ in keys], pa.string()), pa.array([p for _, p in keys], pa.int32()), pa.array(list(counts.values()), pa.int64())],
                names=["g", "part", "n"],
            )

    found = rows.mapInArrow(run, "g string, part int, n long")
    return found.groupBy("g").agg(*[F.sum(F.when(F.col("part") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(4)])


def train(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, max_entries: int):
    """The model of all training rows, and the calibration. docs: id, text; labels: id and the label."""
    import numpy as np
    import pyarrow as pa

    chosen = labels.where(F.col(label).isNotNull() & (fold("id", 5) != 0)).dropDuplicates(["id"])
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    part = (F.pmod(F.xxhash64("id"), F.lit(2)) * 2 + F.col(label)).cast("int")
    rows = docs.join(chosen.select("id", part.alias("part")), "id").dropDuplicates(["id"]).select("text", "part")
    rows = saved(rows, "toxic-rows")
    total = F.col("n0") + F.col("n1") + F.col("n2") + F.col("n3")
    table = count_grams(rows).orderBy(total.desc(), "g").limit(max_entries).toArrow()
    grams = table.column("g").to_pylist()
    n = np.column_stack([table.column(f"n{i}").to_numpy() for i in range(4)])

    def model(halves: list[int]) -> Model:
        counts = [sum(n[:, 2 * h + y] for h in halves) for y in (0, 1)]
        kept = np.flatnonzero(counts[0] + counts[1])
        own = [grams[i] for i in kept]
        follows: dict[str, int] = {}
        for g in own:
            follows[g[1:]] = follows.get(g[1:], 0) + 1
        low = dict(zip(follows, lower_order(list(follows), list(follows.values())), strict=True))
        return Model(own, [low[g[1:]] for g in own], [c[kept] for c in counts])

    shared = docs.sparkSession.sparkContext.broadcast([model([0]), model([1])])

    def run(batches):
        for batch in batches:
            texts, kinds = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist())
            first, second = (m.figures(texts) for m in shared.value)
            x = np.where((kinds // 2 == 0)[:, None], second, first)  # by the model of the other half
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*x.T, kinds % 2.0)], names=[*FIGURES, "y"])

    seen = rows.mapInArrow(run, ", ".join(f"{c} double" for c in [*FIGURES, "y"])).orderBy(*FIGURES, "y").toArrow()
    if not seen.num_rows:
        return model([0, 1]), np.zeros(len(FIGURES) + 1)
    x = np.column_stack([seen.column(c).to_numpy() for c in FIGURES])
    return model([0, 1]), logistic(x, seen.column("y").to_numpy())


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.5,
    max_rows: int = 4000,
    max_entries: int = 1 << 19,
) -> DataFrame:
    """Score every text; learn from at most `max_rows` labelled rows with crc32(id) mod 5 other than 0.

    `max_entries` bounds the grams of the model (the most frequent stay), and with them what is broadcast. Returns
    id_col, held_out, score (0 to 1) and predicted (score >= threshold). Null, empty and blank texts score alike;
    rows with a null id are scored, and held out; null labels teach nothing; without any label every score is 0.5. Repeated
    rows come back repeatedly; other columns are not read; an empty table gives no rows.
    """
    import numpy as np

    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    labels = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias(label))
    model, weights = train(docs, labels, label, max_rows, max_entries)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pd.Series) -> pd.Series:
        x = shared.value.figures(texts.tolist())
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))), dtype="float64")

    score = F.pandas_udf(run, "double")(F.col("text"))
    return docs.select(
        F.col("id").alias(id_col),
        F.coalesce(fold("id", 5) == 0, F.lit(True)).alias("held_out"),
        score.alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
