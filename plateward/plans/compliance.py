"""Train, evaluate and store the compliance classifier."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from plateward.operators import boosting, evaluate, model as classifier
from plateward.operators.features import (
    encode,
    impute,
    modelling_set,
    stored_label_codes,
    temporal_split,
    with_weight,
)
from plateward.session import scratch_path, stored
from plateward.values import TREES

POINTER = "trained"
POINTER_TYPE = "trained_at timestamp, folder string, learner string"

Model = PipelineModel | boosting.Boosted


class Learner(NamedTuple):
    """How a model is fitted on weighted rows, used and kept."""

    fit: Callable[[DataFrame, int], Model]
    score: Callable[[Model, DataFrame], DataFrame]
    importances: Callable[[SparkSession, Model], DataFrame]
    save: Callable[[SparkSession, Model, str], None]
    load: Callable[[SparkSession, str], Model]


FIRST_ORDER, SECOND_ORDER = "first order", "second order"
LEARNERS = {
    FIRST_ORDER: Learner(
        lambda rows, trees: classifier.fit(rows, trees),
        classifier.score, classifier.importances, lambda _, m, path: classifier.save(m, path),
        lambda _, path: classifier.load(path),
    ),
    SECOND_ORDER: Learner(
        lambda rows, trees: boosting.train(rows, settings=boosting.Settings(trees=trees))[0],
        boosting.score, boosting.importances, boosting.save, boosting.load,
    ),
}


@dataclass(frozen=True)
class Compliance:
    model: Model
    codes: DataFrame
    scored: DataFrame  # test rows with prediction and score
    learner: str = FIRST_ORDER

    @property
    def tables(self) -> dict[str, DataFrame]:
        """Evaluation tables over the test rows. The scores are counted once."""
        spark = self.scored.sparkSession
        counts = evaluate.score_counts(self.scored)
        return {
            "roc_auc": evaluate.roc_auc(self.scored, counts=counts),
            "roc_curve": evaluate.roc_curve(self.scored, counts=counts),
            "confusion": evaluate.confusion(self.scored),
            "classification_report": evaluate.classification_report(self.scored),
            "importances": LEARNERS[self.learner].importances(spark, self.model),
        }


def encoded_set(mart: DataFrame, codes_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The numeric modelling set and the label codes it was encoded with.

    The set is stored first: coding, weighting and training each read it.
    """
    rows = stored(impute(modelling_set(mart)), "modelling-set")
    codes = stored_label_codes(rows, codes_path)
    return encode(rows, codes), codes


def train(mart: DataFrame, path: str | None = None, trees: int = TREES, learner: str = FIRST_ORDER) -> Compliance:
    """Fit on the years up to the split and score the later ones.

    ``learner`` is ``FIRST_ORDER``, Spark's own trees, or ``SECOND_ORDER``, those of ``boosting``.

    Below ``path`` each training has a folder of its own with the model
    (``model``), its label codes (``label_codes``) and the scored test rows
    (``scored``). When all are complete one row is added to ``trained``, which
    ``current`` follows: a failing training leaves the last good one, with its codes.
    """
    spark = mart.sparkSession
    path = path or scratch_path(spark, "compliance")
    folder = f"{path}/run={uuid.uuid4().hex}"
    rows, codes = encoded_set(mart, f"{folder}/label_codes")
    training, test = temporal_split(rows)
    # Trees pass over the rows again and again: encode and weight them once. Sums
    # of floating-point errors depend on the order of rows, so that is fixed too.
    arranged = with_weight(training).repartition("inspection_id").sortWithinPartitions("inspection_id")
    weighted = stored(arranged, "training")
    use = LEARNERS[learner]
    model = use.fit(weighted, trees)
    use.save(spark, model, f"{folder}/model")
    scored = stored(use.score(model, test), "scored", f"{folder}/scored")
    values = datetime.now(timezone.utc), folder, learner
    names = ("trained_at", "folder", "learner")
    row = spark.range(1).select(*(F.lit(value).alias(name) for name, value in zip(names, values)))
    row.coalesce(1).write.mode("append").parquet(f"{path}/{POINTER}")
    return Compliance(model, codes, scored, learner)


def current(spark: SparkSession, path: str) -> Compliance:
    """The training completed last below ``path``."""
    trainings = spark.read.schema(POINTER_TYPE).parquet(f"{path}/{POINTER}")
    last = trainings.orderBy(F.desc("trained_at")).first()
    learner, folder = last.learner or FIRST_ORDER, last.folder
    return Compliance(
        LEARNERS[learner].load(spark, f"{folder}/model"),
        spark.read.parquet(f"{folder}/label_codes"),
        spark.read.parquet(f"{folder}/scored"),
        learner,
    )
