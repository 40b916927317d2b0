"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has a mean and a covariance of the transformed statistics. The class
covariance is shrunk towards the pooled one and then towards a multiple of the
identity. Its Cholesky factor is computed once, on the driver, from sums that
Spark aggregated; scores come from the difference of the two Mahalanobis
log-densities.

Statistics are built-in column functions. Only their short vectors reach
Python, in Arrow batches.

Defined results: NULL and empty texts have all statistics 0 and are scored.
A label that is neither 0 nor 1, or whose id is NULL or unknown, is not learnt;
a document with several labels counts with each. If a class has no labels the
score is the share of the other (0.5 if there are none at all). Repeated rows
are scored each. Empty tables give empty results. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plateward.llm.common import WHITE_SPACE, let, words
from plateward.session import stored

FOLDS = 5
HELD_OUT = 0
THRESHOLD = 0.3
# Shrinkage of a class covariance: towards the pooled one, then towards the identity.
TO_POOLED = 0.5
TO_IDENTITY = 0.02
# Densities differ by at most so much before they become a score.
MOST = 700.0


def statistics(text: Column, tokens: Column, lines: Column) -> dict[str, Column]:
    """Transformed statistics of a document, by name. ``tokens`` and ``lines`` are arrays."""
    n_chars = F.length(F.regexp_replace(text, WHITE_SPACE, ""))
    n_words, n_lines = F.size(tokens), F.size(lines)
    share = lambda part, whole: F.sqrt(part / F.greatest(whole, F.lit(1)))
    count = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    adjacent = lambda t: F.size(
        F.filter(t, lambda w, k: F.coalesce(F.get(t, k - 1) == w, F.lit(False)))
    )
    return {
        "log_words": F.log1p(n_words),
        "word_length": F.log1p(n_chars / F.greatest(n_words, F.lit(1))),
        "symbols": share(count(r"[^#*$%&|<>]+"), n_chars),
        "bars": share(count(r"[^|]+"), n_words),
        "capitals": share(count(r"[^\p{Lu}]+"), n_chars),
        "digits": share(count(r"[^0-9]+"), n_chars),
        "stops": share(count(r"[^.,]+"), n_words),
        "exclamations": share(count(r"[^!?]+"), n_words),
        "others": share(count(r"[\p{L}0-9\s.,!?#*$%&|<>]+"), n_chars),
        "distinct_words": F.size(F.array_distinct(tokens)) / F.sqrt(F.greatest(n_words, F.lit(1))),
        "doubled_words": share(let(tokens, adjacent), n_words),
        "doubled_lines": share(n_lines - F.size(F.array_distinct(lines)), n_lines),
        "line_length": F.log1p(n_words / F.greatest(n_lines, F.lit(1))),
    }


def described(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id`` and ``x``, the array of statistics, for every row."""
    text = F.col("text")
    lined = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    ).withColumns({"words": words(text), "lines": F.array_remove(F.split(text, "\n"), "")})
    values = statistics(text, F.col("words"), F.col("lines")).values()
    return lined.select("id", F.array(*(v.cast("double") for v in values)).alias("x"))


def is_held_out(record_id: Column) -> Column:
    """Whether crc32 of the id as text has the remainder that is never learnt from."""
    crc = F.crc32(F.coalesce(record_id.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(FOLDS)) == HELD_OUT


class Model(NamedTuple):
    """Scaling of the statistics; per class the mean, the inverse Cholesky factor and the log weight."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]
    weights: tuple[float, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1."""
        if not self.factors:
            return np.full(len(x), self.weights[0])
        z = (x - self.centre) / self.scale
        density = [
            w - 0.5 * (((z - m) @ f.T) ** 2).sum(axis=1)
            for m, f, w in zip(self.means, self.factors, self.weights)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -MOST, MOST)))


def _moments(labelled: DataFrame, k: int) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per class: rows, sums and sums of products of ``x``. At most two rows reach the driver."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    x = [F.col("x")[i] for i in range(k)]
    sums = [F.sum(x[i]) for i in range(k)] + [F.sum(x[i] * x[j]) for i, j in pairs]
    rows = labelled.groupBy("label").agg(F.count("*").alias("n"), F.array(*sums).alias("s")).collect()
    found = {}
    for row in rows:
        s = np.array(row["s"])
        products = np.zeros((k, k))
        for (i, j), value in zip(pairs, s[k:]):
            products[i, j] = products[j, i] = value
        found[row["label"]] = (row["n"], s[:k], products)
    return found


def fit(labelled: DataFrame, to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> Model:
    """A model from rows with ``label`` 0 or 1 and ``x``, all of which are used.

    Products are summed about the common mean, so that they lose no digits.
    """
    first = labelled.agg(
        F.count("*").alias("n"), F.sum("label").alias("ones"), F.max(F.size("x")).alias("k")
    ).first()
    n, ones = first["n"], first["ones"] or 0
    if not n or ones in (0, n):
        return Model(np.zeros(0), np.ones(0), (), (), (ones / n if n else 0.5,))
    k = first["k"]
    averages = labelled.agg(
        F.array(*(F.avg(F.col("x")[i]) for i in range(k))).alias("m"),
        F.array(*(F.stddev_pop(F.col("x")[i]) for i in range(k))).alias("s"),
    ).first()
    centre, scale = np.array(averages["m"]), np.maximum(np.array(averages["s"]), 1e-6)
    c, s = [float(v) for v in centre], [float(v) for v in scale]
    scaled = F.array(*((F.col("x")[i] - c[i]) / s[i] for i in range(k)))
    classes = _moments(labelled.select("label", scaled.alias("x")), k)
    means = {y: sums / m for y, (m, sums, _) in classes.items()}
    spread = {y: p / m - np.outer(means[y], means[y]) for y, (m, _, p) in classes.items()}
    pooled = sum(classes[y][0] * spread[y] for y in classes) / n
    factors, weights = [], []
    for y in (0, 1):
        covariance = (1 - to_pooled) * spread[y] + to_pooled * pooled
        covariance = (1 - to_identity) * covariance + to_identity * np.trace(covariance) / k * np.eye(k)
        lower = np.linalg.cholesky(covariance + 1e-9 * np.eye(k))
        factors.append(np.linalg.inv(lower))
        weights.append(math.log(classes[y][0] / n) - float(np.log(np.diag(lower)).sum()))
    return Model(centre, scale, (means[0], means[1]), tuple(factors), tuple(weights))


def scored(described_rows: DataFrame, model: Model) -> DataFrame:
    """``id`` and ``score`` of ``described`` rows."""
    kind = described_rows.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch["x"].flatten().to_numpy(zero_copy_only=False)
            scores = model.score(values.reshape(batch.num_rows, -1)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(scores, pa.float64())], names=["id", "score"]
            )

    return described_rows.select("id", "x").mapInArrow(score, f"id {kind}, score double")


def classified(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> DataFrame:
    """Per document: id, ``held_out``, ``score`` and ``predicted``."""
    rows = stored(described(docs, id_column, text_column), "statistics")
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~is_held_out(F.col("id")))
    model = fit(rows.join(known, "id"))
    return scored(rows, model).select(
        F.col("id").alias(id_column),
        is_held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with their columns, that the classifier does not reject."""
    text = F.col(f"`{text_column}`")
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~is_held_out(F.col("id")))
    wanted = docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text")).join(
        known.select("id").distinct(), "id", "left_semi"
    )
    model = fit(stored(described(wanted, "id", "text"), "statistics").join(known, "id"))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(whole, text.alias("text"))
    return (
        scored(described(rows, "row", "text"), model)
        .where(F.col("score") >= THRESHOLD)
        .select("id.*")
    )
