"""A quality score by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are documents labelled good; unlabelled web text is every document of the learning folds, whatever its
label, since a positive-unlabelled learner does not look at bad ones. The class prior, the share of good documents in
that text, is estimated from the share of all its rows that lie where nearly all positives lie, against the positives'
own share there. The classifier minimises

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss over shape features of the whole text: repetition, symbols, upper case, word lengths,
compressibility. Labels, language, source and id are no features.

Features of all documents are computed once, in Spark tasks, and written; scoring reads them again and is an
expression over an array. Moments over all documents scale the features. Only the fit, and the range in which the
class prior is counted, use a sample: the ``FIT_ROWS`` positives and as many unlabelled rows with the smallest hashes
of their ids and features, which bounds what the driver holds at every size of the corpus. Only rows alike in both are
taken together.

Defined results: null and empty texts have the features of the empty text and a score like any other. Null ids belong
to no held-out fold and have no label. Repeated rows have equal scores. Without any positive label every score is 1,
since nothing is known against a document. Labels of ids with differing labels count as good only if none is bad.
"""

from __future__ import annotations

import functools
import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crewgauge.llm.batches import smaller
from crewgauge.llm.scratch import written

#: Rows of each kind that the fit takes at most.
FIT_ROWS = 20_000
#: Score from which a document counts as good.
THRESHOLD = 0.7
_SYMBOLS = "#$%&*|!<>{}[]=+~^\\/_@"
_DIGITS = "0123456789"
FEATURES = (
    "chars words word_length upper_words symbols bars exclamations digits same_word_again top_word distinct_words short_words "
    "compressed odd_endings stops lines capitals"
).split()


def features(text: str) -> list[float]:
    """The shape of a text, each as a share or a logarithm."""
    words = text.split()
    chars, many = max(len(text), 1), max(len(words), 1)
    counts = Counter(words)
    return [
        float(np.log1p(len(text))),
        float(np.log1p(len(words))),
        len(text) / many,
        sum(w.isupper() and len(w) > 1 for w in words) / many,
        sum(map(text.count, _SYMBOLS)) / chars,
        text.count("|") / chars,
        text.count("!") / chars,
        sum(map(text.count, _DIGITS)) / chars,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / many,
        max(counts.values(), default=0) / many,
        len(counts) / many,
        sum(len(w) <= 3 for w in words) / many,
        len(zlib.compress(text.encode("utf-8", "replace"), 1)) / chars if text else 0.0,
        sum(not w[-1].isalnum() and w[-1] not in ".,;:)" for w in words) / many,
        (text.count(".") + text.count(",")) / many,
        (text.count("\n") + 1) / many,
        sum(w[0].isupper() for w in words) / many,
    ]


def held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    """Whether crc32 of the id as text falls on the fold that is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, f): the features of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller(batches):
            f = [features(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f, pa.list_(pa.float64()))], ["doc_id", "f"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, f array<double>")


@dataclass(frozen=True)
class Model:
    """A linear score over scaled features and their excess beyond what good documents have."""

    mean: np.ndarray
    scale: np.ndarray
    low: np.ndarray
    high: np.ndarray
    weights: np.ndarray
    bias: float

    def inputs(self, f: np.ndarray) -> np.ndarray:
        return _inputs(f, self.mean, self.scale, self.low, self.high)

    def scores(self, f: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(f) @ self.weights + self.bias, -30, 30)))

    def score(self, f: Column) -> Column:
        """The same score as an expression over an array of features."""
        total, n = F.lit(float(self.bias)), len(self.mean)
        for k in range(n):
            z = (f[k] - float(self.mean[k])) / float(self.scale[k])
            total += F.greatest(F.lit(-_CLIP), F.least(F.lit(_CLIP), z)) * float(self.weights[k])
            over, under = (f[k] - float(self.high[k])) / float(self.scale[k]), (float(self.low[k]) - f[k]) / float(self.scale[k])
            for part, w in ((over, self.weights[n + k]), (under, self.weights[2 * n + k])):
                total += F.greatest(F.lit(0.0), F.least(F.lit(1.0), part * _STEEP)) * float(w)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))))


_CLIP, _STEEP = 3.0, 4.0


def _inputs(f: np.ndarray, mean: np.ndarray, scale: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    z = np.clip((f - mean) / scale, -_CLIP, _CLIP)
    return np.hstack([z, np.clip((f - high) / scale * _STEEP, 0, 1), np.clip((low - f) / scale * _STEEP, 0, 1)])


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, mean: np.ndarray, scale: np.ndarray, steps: int = 1500) -> Model:
    """The non-negative risk's minimum by full-batch gradient steps with momentum and step sizes per weight."""
    low, high = np.quantile(positive, 0.01, axis=0), np.quantile(positive, 0.99, axis=0)
    shape = (mean, scale, low, high)
    p, u = (np.hstack([_inputs(f, *shape), np.ones((len(f), 1))]) for f in (positive, unlabelled))
    w = np.zeros(p.shape[1])
    first, second = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        up = -(p.T @ sigmoid(-zp)) / len(p)  # of the loss of calling positives good
        down = (u.T @ sigmoid(zu)) / len(u) - prior * (p.T @ sigmoid(zp)) / len(p)
        risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        # a negative risk of the bad class is overfitting: it is climbed back, the rest waits
        grad = (prior * up + down if risk >= 0 else -down) + 1e-3 * np.append(w[:-1], 0)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w = w - 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(*shape, w[:-1], float(w[-1]))


def _sample(rows: DataFrame, limit: int) -> np.ndarray:
    """The features of the ``limit`` rows with the smallest hashes of their ids and features; about half as many more are ranked."""
    share, hashed = min(1.0, 1.5 * limit / max(rows.count(), 1)), F.pmod(F.xxhash64("doc_id", "f"), F.lit(1 << 40))
    arrow = rows.where(hashed < int(share * (1 << 40))).orderBy(hashed, "doc_id").limit(limit).select("f").toArrow().column("f").combine_chunks()
    return np.asarray(arrow.values.to_numpy(), float).reshape(len(arrow), len(FEATURES))


def class_prior(learning: DataFrame, positive: np.ndarray) -> float:
    """The share of good rows among all of ``learning`` (f, quality); ``positive`` gives the range that is counted.

    A row in which each feature is between the positives' hundredths counts as alike. If bad rows are never alike, the
    share of alike rows is the prior times the positives' own share; those that are alike raise the estimate.
    """
    low, high = np.quantile(positive, [0.01, 0.99], axis=0)
    alike = functools.reduce(operator.and_, (F.col("f")[k].between(float(a), float(b)) for k, (a, b) in enumerate(zip(low, high, strict=True))))
    of_all, of_good = learning.agg(F.avg(alike.cast("double")), F.avg(F.when(F.col("quality") == 1, alike.cast("double")))).first()
    return float(np.clip((of_all or 0.0) / max(of_good or 0.0, 1e-9), 0.01, 0.99))


def learn(table: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model | None:
    """The model from (doc_id, f) and (doc_id, quality); None without a positive label in the learning folds."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = written(known.agg(F.min("quality").alias("quality")).where(~held_out(F.col("doc_id"))), "labels")
    learning = table.where(~held_out(F.col("doc_id"))).join(known, "doc_id", "left")
    positive = _sample(learning.where("quality = 1"), rows)
    unlabelled = _sample(learning, rows)
    if not len(positive):
        return None
    moments = table.agg(*(F.avg(F.col("f")[k]) for k in range(len(FEATURES))), *(F.stddev_pop(F.col("f")[k]) for k in range(len(FEATURES)))).first()
    mean, scale = np.array(moments, float).reshape(2, -1)
    return fit(positive, unlabelled, class_prior(learning, positive), mean, scale + 1e-9)


def scored(table: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of (doc_id, f)."""
    score = model.score(F.col("f")) if model else F.lit(1.0)
    rows = table.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, with all their columns."""
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller(batches):
            f = np.array([features(text or "") for text in batch.column(place).to_pylist()]).reshape(batch.num_rows, len(FEATURES))
            yield batch.filter(pa.array(model.scores(f) >= threshold))

    place = docs.columns.index(text_col)
    return docs.mapInArrow(run, docs.schema)
