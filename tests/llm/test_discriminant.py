import zlib

import numpy as np
import pytest

from plateward.llm import discriminant as d
from plateward.llm.queries import queries

FOLDER = "/root/testdata/sf0.01"


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in queries()["op7_quadratic_discriminant"](spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality IS NOT NULL").collect()
    for k, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    held = [(rows[x["doc_id"]], x["quality"]) for x in labels if rows[x["doc_id"]]["held_out"]]
    assert len(held) > 50
    assert np.mean([r["predicted"] == y for r, y in held]) > 0.93
    assert auc([(r["score"], y) for r, y in held]) > 0.85
    assert np.mean([r["predicted"] for r, y in held if y]) > 0.97


def test_model_equals_direct_computation(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate((rng.normal(0, 1, (80, 3)), rng.normal(1, 2, (120, 3)) @ rng.normal(0, 1, (3, 3))))
    y = np.repeat([0, 1], [80, 120])
    df = spark.createDataFrame([(int(b), a.tolist()) for a, b in zip(x, y)], "label int, x array<double>")
    model = d.fit(df)
    z = (x - x.mean(0)) / x.std(0)
    cov = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
    pooled = (80 * cov[0] + 120 * cov[1]) / 200
    logs = []
    for c in (0, 1):
        s = (1 - d.TO_POOLED) * cov[c] + d.TO_POOLED * pooled
        s = (1 - d.TO_IDENTITY) * s + d.TO_IDENTITY * np.trace(s) / 3 * np.eye(3) + 1e-9 * np.eye(3)
        diff = z - z[y == c].mean(0)
        mahalanobis = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(s), diff)
        logs.append(np.log(np.mean(y == c)) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * mahalanobis)
    assert model.score(x) == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])))


def test_awkward(spark, awkward, labels, nothing):
    assert d.classified(awkward, labels).count() == awkward.count()
    assert d.accepted(awkward, labels).columns == awkward.columns
    for few, score in ((labels.where("quality = 1"), 1.0), (labels.limit(0), 0.5)):
        assert {r["score"] for r in d.classified(awkward, few).collect()} == {score}
        assert d.accepted(awkward, few).count() == awkward.count()
    assert d.classified(nothing, labels).count() == 0 and d.accepted(nothing, labels).count() == 0


def test_stage_agrees_with_scores(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    want = {r["doc_id"] for r in d.classified(docs, labels).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in d.accepted(docs, labels).collect()} == want
