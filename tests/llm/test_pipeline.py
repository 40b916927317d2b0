"""Each stage of the pipeline against what its input and output must show."""

import pytest

import corpus_pipeline
from plateward.llm import discriminant
from plateward.session import stored
from llm.test_decontamination import brute as contaminated
from llm.test_entropy_mix import checked
from llm.test_jaccard_join import brute as similar

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    out[None] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = stored(stage(spark, docs, FOLDER), name)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages(results):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "benchmark_passages", "mixing", "sharding"]
    for name in names[:-1]:
        assert results[name].schema == results[None].schema


def test_quality(spark, results):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = discriminant.classified(results[None], labels).where("predicted = 1")
    assert ids(results["quality"]) == ids(scores)
    good = ids(labels.where("quality = 1"))
    assert len(good & ids(results["quality"])) >= 0.95 * len(good)


def test_near_duplicates(results):
    docs = [tuple(r) for r in results["quality"].select("doc_id", "text").collect()]
    want = {c if n else d for d, n, c in similar(docs)}
    assert ids(results["near_duplicates"]) == want and results["near_duplicates"].count() == len(want)


def test_benchmark_passages(spark, results):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [tuple(r) for r in results["near_duplicates"].select("doc_id", "text").collect()]
    assert ids(results["benchmark_passages"]) == {r[0] for r in contaminated(docs, items) if not r[-1]}


def test_mixing(results):
    before = {r["doc_id"]: r for r in results["benchmark_passages"].collect()}
    copies = {}
    for r in results["mixing"].collect():
        assert r == before[r["doc_id"]]
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    size = {k: len(r["text"].split()) for k, r in before.items()}
    total = {}
    for k, r in before.items():
        total[r["source"]] = total.get(r["source"], 0) + size[k]
    from llm.test_entropy_mix import targets

    want = targets(total)
    rows = [
        (r["source"], size[k], total[r["source"]], want[r["source"]], size[k] * copies.get(k, 0))
        for k, r in before.items()
    ]
    checked(rows, lambda s, t: 0.1 * t + 200)


def test_sharding(results):
    rows = results["sharding"].collect()
    assert len(rows) == results["mixing"].count()
    places = {}
    for r in rows:
        places.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_near_duplicates_by_five_words_and_80_percent(spark):
    base = [f"w{k}" for k in range(100)]
    # Two single words changed: 86 of 106 five-word shingles shared, 89 of 105 four-word ones (0.848).
    near = [*base[:30], "x", *base[31:60], "y", *base[61:]]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near))], "doc_id bigint, text string")
    assert ids(corpus_pipeline.near_duplicates(spark, docs, FOLDER)) == {1}


@pytest.fixture(scope="module")
def odd_tables(tmp_path_factory, awkward, nothing, benchmark, labels):
    """Folders of awkward and of empty tables; documents have columns named like what stages compute."""
    names = "place rows_before source_size given_size map_version __x".split()
    folders = {}
    for kind, docs in (("awkward", awkward), ("empty", nothing)):
        folder = tmp_path_factory.mktemp(kind)
        more = docs.selectExpr("*", *(f"'{n}' AS `{n}`" for n in names))
        for name, df in (("documents", more), ("benchmark", benchmark), ("labels", labels)):
            (df if kind == "awkward" else df.limit(0)).write.parquet(f"{folder}/{name}.parquet")
        folders[kind] = str(folder)
    return folders


def test_columns_keep_value_and_type_through_all_stages(spark, odd_tables):
    folder = odd_tables["awkward"]
    docs = first = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:]:
        rows = {tuple(r) for r in docs.collect()}
        docs = stored(stage(spark, docs, folder), name)
        if name != "sharding":
            assert docs.schema == first.schema
            assert {tuple(r) for r in docs.collect()} <= rows
    assert docs.count() > 0
    r = docs.first()
    assert (r["place"], r["rows_before"], r["source_size"], r["given_size"]) == ("place", "rows_before", "source_size", "given_size")
    assert (r["given_given_size"], r["given_shard"], r["given_map_version"], r["rate"]) == ("c", "c", "map_version", "c")
    assert isinstance(r["size"], int) and isinstance(r["shard"], int)


def test_empty_tables(spark, odd_tables):
    assert corpus_pipeline.run(spark, odd_tables["empty"]).count() == 0
