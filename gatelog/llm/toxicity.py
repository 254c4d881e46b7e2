"""Toxicity by a classifier chain: a linear model per category, each fed the earlier categories' probabilities.

Features are the distinct words of a text and the words' beginnings (four to six letters and a star),
chosen by how strongly they go with a category. For training, the earlier categories' probabilities are
out-of-fold predictions: each fold's come from models that have not seen it, as a scored text has not
been seen. The final models are fitted on all training rows.

Training takes a bounded sample of the labelled rows (``MAX_ROWS``, chosen by a hash of the id) and
bounded numbers of features; counting words over the sample and scoring run on the executors.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelog.llm.common import small_batches, stored

#: Labelled rows trained on at most; words per category; least rows with a word; least chi-square of a word; folds.
MAX_ROWS, MAX_WORDS, LEAST_ROWS, LEAST_CHI2, FOLDS = 10_000, 300, 4, 25.0, 3
#: Probability from which a text is rejected; strength of the penalty on weights.
THRESHOLD, PENALTY = 0.5, 0.1
#: Words a worker remembers (bounds its memory).
CACHE_ENTRIES = 300_000
_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) > n)]


def text_features(text: str | None) -> set[str]:
    return {f for w in set(_WORD.findall((text or "").lower())) for f in features(w)}


def matrix(x: list[np.ndarray], n_features: int) -> np.ndarray:
    """Rows of feature numbers as ones and zeros; at most ``MAX_ROWS`` by twice ``MAX_WORDS``."""
    out = np.zeros((len(x), n_features), np.float32)
    for i, row in enumerate(x):
        out[i, row] = 1
    return out


def fit(x: np.ndarray, extra: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Logistic regression by Newton's method.

    Weights: features, then ``extra`` columns, then the constant, which is not penalised.
    """
    wide = np.column_stack([x, extra, np.ones(len(y))]).astype(np.float32)
    weights = np.zeros(wide.shape[1])
    ridge = np.full(len(weights), penalty)
    ridge[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(wide @ weights.astype(np.float32), -30, 30).astype(float)))
        gradient = wide.T @ (p - y).astype(np.float32) + ridge * weights
        curve = np.sqrt(np.maximum(p * (1 - p), 1e-6)).astype(np.float32)
        half = wide * curve[:, None]
        step = np.linalg.solve((half.T @ half).astype(float) + np.diag(ridge), -gradient)
        weights += step
        if np.abs(step).max() < 1e-3:
            break
    return weights


@dataclass
class Chain:
    """Words by number and, per category in order, weights over words, earlier probabilities and a constant."""

    categories: list[str]
    numbers: dict[str, int]
    weights: list[np.ndarray]

    def probabilities(self, x: list[np.ndarray]) -> np.ndarray:
        out = np.empty((len(x), len(self.categories)))
        n = len(self.numbers)
        for c, w in enumerate(self.weights):
            sums = np.array([w[r].sum() for r in x]) if x else np.empty(0)
            out[:, c] = 1 / (1 + np.exp(-np.clip(sums + out[:, :c] @ w[n : n + c] + w[-1], -30, 30)))
        return out

    @staticmethod
    def train(categories: list[str], words: list[str], x: list[np.ndarray], y: np.ndarray, folds: np.ndarray) -> Chain:
        """A category with one kind of label only, or no rows, predicts its (smoothed) base rate."""
        numbers = {w: i for i, w in enumerate(words)}
        dense, earlier = matrix(x, len(words)), np.empty((len(x), 0))
        weights = []
        for c in range(len(categories)):
            target = y[:, c].astype(float)
            weights.append(fit(dense, earlier, target) if len(x) else np.zeros(len(words) + c + 1))
            unseen = np.zeros(len(x))
            for fold in np.unique(folds):
                rest, own = folds != fold, folds == fold
                if rest.any():
                    w = fit(dense[rest], earlier[rest], target[rest])
                    sums = dense[own] @ w[: len(words)] + earlier[own] @ w[len(words) : -1] + w[-1]
                    unseen[own] = 1 / (1 + np.exp(-np.clip(sums, -30, 30)))
            earlier = np.column_stack([earlier, unseen])
        return Chain(categories, numbers, weights)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], key: str = "doc_id", text: str = "text", label_key: str = "doc_id", max_rows: int = MAX_ROWS) -> Chain:
    """A chain over ``categories`` (name → 0/1 column of ``labels``), in their order.

    Labels with a null id or category are left out; of repeated ids the greatest labels count and the
    least text does, so that ``max_rows`` bounds the rows, too.
    """
    small_batches(docs.sparkSession)
    names = list(categories)
    told = labels.select(F.col(label_key).alias("id"), *(c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values()))).dropna()
    unique = told.groupBy("id").agg(*(F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))))
    sample = unique.orderBy(F.xxhash64("id"), "id").limit(max_rows)  # so the broadcast has max_rows short rows at most
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    rows = stored(texts.groupBy("id").agg(F.min("text").alias("text"), *(F.first(f"y{i}").alias(f"y{i}") for i in range(len(names)))))
    ys = [f"y{i}" for i in range(len(names))]
    rows = rows.select("id", "text", F.pmod(F.xxhash64(F.lit("fold"), F.col("id").cast("string")), F.lit(FOLDS)).cast("int").alias("fold"), *ys)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, hits = Counter(), [Counter() for _ in ys]
        for batch in batches:
            flags = [batch.column(i + 1).to_pylist() for i in range(len(ys))]
            for i, value in enumerate(batch.column(0)):
                own = text_features(value.as_py())
                totals.update(own)
                for flag, hit in zip(flags, hits, strict=True):
                    if flag[i]:
                        hit.update(own)
                if len(totals) > 400_000:
                    yield _counts(totals, hits)
                    totals, hits = Counter(), [Counter() for _ in ys]
        yield _counts(totals, hits)

    def _counts(totals, hits):
        words = list(totals)
        columns = [pa.array(words, pa.string()), pa.array([totals[w] for w in words], pa.int64())]
        columns += [pa.array([h[w] for w in words], pa.int64()) for h in hits]
        return pa.RecordBatch.from_arrays(columns, ["word", "n", *ys])

    sums = rows.agg(F.count("*").alias("n"), *(F.sum(y).alias(y) for y in ys)).first()
    counts = rows.select("text", *ys).mapInArrow(counted, "word string, n long" + "".join(f", {y} long" for y in ys))
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"), *(F.sum(y).alias(y) for y in ys)).where(F.col("n") >= LEAST_ROWS)
    total = float(sums["n"] or 0)
    measured = []
    for y in ys:
        marked = float(sums[y] or 0)
        a, n = F.col(y), F.col("n")
        spread = (a * F.lit(total) - n * F.lit(marked)) / F.lit(max(total, 1.0))
        chi = spread * spread * F.lit(total**3) / (n * (F.lit(total) - n + 0.5) * F.lit(max(marked * (total - marked), 1.0)))
        measured.append(chi.alias(f"c{y}"))
    scored = counts.select("word", *measured)
    words = sorted({r["word"] for y in ys for r in scored.where(F.col(f"c{y}") >= LEAST_CHI2).orderBy(F.desc(f"c{y}"), "word").limit(MAX_WORDS).collect()})
    numbers = {w: i for i, w in enumerate(words)}
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    @F.arrow_udf("array<int>")
    def chosen(texts: pa.Array) -> pa.Array:
        own = shared.value
        return pa.array([sorted(own[f] for f in text_features(t.as_py()) if f in own) for t in texts], pa.list_(pa.int32()))

    table = rows.select("id", "fold", *ys, chosen("text").alias("x")).toPandas()
    table = table.sort_values("id", kind="stable")
    x = [np.asarray(r, np.int64) for r in table["x"]]
    return Chain.train(names, words, x, table[ys].to_numpy(), table["fold"].to_numpy())


class _Known(dict):
    """Word → numbers of its features, or None; bounded."""

    def __init__(self, numbers: dict[str, int]) -> None:
        super().__init__()
        self.numbers = numbers

    def __missing__(self, word: str):
        found = tuple(self.numbers[f] for f in features(word) if f in self.numbers) or None
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = found
        return found


def probability(chain: Chain, spark, text: Column) -> Column:
    """Per text an array of the categories' probabilities, in the chain's order."""
    shared = spark.sparkContext.broadcast(chain)

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        known = _Known(own.numbers)
        for texts in batches:
            x = []
            for value in texts:
                found = filter(None, map(known.__getitem__, _WORD.findall((value.as_py() or "").lower())))
                x.append(np.fromiter({i for t in found for i in t}, np.int64))
            yield pa.array(own.probabilities(x).tolist(), pa.list_(pa.float64()))

    return run(text)


def scored(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], reject: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, p_<category> for each category, rejected.

    Null and empty texts have no words and get the base rates' probabilities; they are not rejected
    unless most training rows are. Repeated rows get equal results, an empty table gives no rows, and
    without usable labels every probability is one half and nothing is rejected. Only the named columns
    are read.
    """
    chain = train(docs, labels, categories, key, text)
    p = probability(chain, docs.sparkSession, F.col(text))
    out = docs.select(F.col(key).alias("doc_id"), p.alias("p"))
    named = [F.get("p", F.lit(i)).alias(f"p_{c}") for i, c in enumerate(categories)]
    return out.select("doc_id", *named, (F.get("p", F.lit(list(categories).index(reject))) > THRESHOLD).alias("rejected"))


def remove_toxic(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], reject: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    chain = train(docs, labels, categories, key, text)
    p = probability(chain, docs.sparkSession, F.col(text))
    return docs.where(F.get(p, F.lit(list(categories).index(reject))) <= THRESHOLD)
