import math

import pytest
from pyspark.sql import functions as F

from plateward.llm.entropy_mix import mixed, repeated, taken_rows
from plateward.llm.queries import queries

FOLDER = "/root/testdata/sf0.001"


def targets(sizes):
    """By the letter: share, stop at the limit, share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def checked(rows, near):
    """``rows``: (source, size, source_size, target, taken)."""
    sizes, taken, stated = {}, {}, {}
    for source, size, _, target, took in rows:
        sizes[source] = sizes.get(source, 0) + size
        taken[source] = taken.get(source, 0) + took
        stated[source] = target
        assert 0 <= took <= 2 * size
    assert all(r[2] == sizes[r[0]] for r in rows)
    want = targets(sizes)
    for source, target in want.items():
        assert stated[source] == pytest.approx(target)
        assert abs(taken[source] - target) <= near(source, target)


def test_query_meets_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source")
    one, two = (queries()["op5_entropy_mix"](spark, FOLDER).sort("doc_id").collect() for _ in range(2))
    assert one == two
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    rows = [(source[r["doc_id"]], r["size"], r["source_size"], r["target"], r["taken"]) for r in one]
    checked(rows, lambda s, t: 0.02 * t + 100)


def test_rates_solve_the_dual(spark):
    """Each source's multiplier by bisection; rates of a source's documents differ by their priors."""
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    by_source = {}
    for r in queries()["op5_entropy_mix"](spark, FOLDER).collect():
        lines = (docs[r["doc_id"]]["text"] or "").split("\n")
        prior = 0.5 + 0.5 * len(set(lines)) / len(lines)
        by_source.setdefault(docs[r["doc_id"]]["source"], []).append((r["size"], prior, r["rate"], r["target"]))
    tilted = 0
    for rows in by_source.values():
        low, high = -50.0, 50.0
        for _ in range(200):
            middle = (low + high) / 2
            words = sum(size * min(2.0, prior * math.exp(middle)) for size, prior, _, _ in rows)
            low, high = (middle, high) if words < rows[0][3] else (low, middle)
        for _, prior, rate, _ in rows:
            assert rate == pytest.approx(min(2.0, prior * math.exp(high)), rel=1e-6)
        tilted += len({round(rate, 9) for _, _, rate, _ in rows}) > 1
    assert tilted >= 3


def test_taken_rows_keep_clashing_columns(spark, awkward):
    rows = taken_rows(awkward)
    assert rows.schema == awkward.schema
    given = {tuple(r) for r in awkward.collect()}
    assert {tuple(r) for r in rows.collect()} <= given
    assert rows.count() == mixed(awkward).agg(F.sum("copies")).first()[0]


def test_awkward(awkward, nothing):
    mix = mixed(awkward)
    assert mix.count() == awkward.count()
    rows = [tuple(r) for r in mix.select("source", "size", "source_size", "target", "taken").collect()]
    checked(rows, lambda s, t: 40_000 if s == "a" else 20)
    assert set(c.lower() for c in awkward.columns) <= set(c.lower() for c in mix.columns)
    assert mixed(nothing).count() == 0
    taken = mix.agg(F.sum("copies")).first()[0]
    assert repeated(mix, awkward.columns[:5]).count() == taken


def test_priors_tilt_documents(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "'s' AS source", "repeat('w ', 20) AS text", "id % 2 AS k")
    other = spark.range(400).selectExpr("id + 1000 AS doc_id", "'t' AS source", "repeat('w ', 20) AS text", "0 AS k")
    prior = F.when(F.col("k") == 1, 3.0).otherwise(1.0)
    rows = mixed(docs.union(other), weights=(1.0, 1.0), share=1.0, prior=prior).where("source = 's'")
    by_k = {r["k"]: r for r in rows.groupBy("k").agg(F.avg("rate").alias("rate"), F.sum("taken").alias("t")).collect()}
    # Rates 1.5 and 0.5: thrice, and together the target.
    assert by_k[1]["rate"] == pytest.approx(3 * by_k[0]["rate"]) and by_k[0]["rate"] == pytest.approx(0.5)
    assert abs(by_k[0]["t"] + by_k[1]["t"] - 8000) <= 40
    # At a high target the favoured rows stop at the cap and the others make up for it.
    rows = mixed(docs, weights=(1.0,), share=1.8, prior=prior)
    assert rows.where("k = 1").agg(F.avg("rate")).first()[0] == 2.0
    assert rows.where("k = 0").agg(F.avg("rate")).first()[0] == pytest.approx(1.6)
