import random
import re

import pytest

from plateward.llm import components as components_module
from plateward.llm.components import components
from plateward.llm.jaccard_join import groups, one_per_group
from plateward.session import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=4):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def brute(docs):
    """(doc_id, set size, component) by all pairs."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 85 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    members = {}
    for k, (doc, _) in enumerate(docs):
        members.setdefault(find(k), []).append(doc)
    least = {r: min((m for m in ms if m is not None), default=None) for r, ms in members.items()}
    return sorted(((doc, len(sets[k]), least[find(k)]) for k, (doc, _) in enumerate(docs)), key=repr)


def found(df):
    rows = groups(df).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def near_copies(rng, n, shared=""):
    base = [f"b{k}" for k in range(60)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append((shared + " ".join(w)).strip())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(30)) + " "
    texts = near_copies(rng, 60) + near_copies(rng, 30, passage)
    texts += [passage + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 20))) for _ in range(60)]
    texts += ["a b c", "A B  C", "a b", "the same text of six words", "", None]
    # A chain: neighbours are linked, the ends are not.
    chain = [f"c{k}" for k in range(80)]
    for k in range(12):
        texts.append(" ".join(chain[k * 3 : k * 3 + 45]))
    docs = [(k, t) for k, t in enumerate(texts)]
    rng.shuffle(docs)
    assert found(spark.createDataFrame(docs, "doc_id bigint, text string")) == brute(docs)


def test_awkward(awkward):
    docs = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    assert found(awkward) == brute(docs)


def test_one_stays(awkward):
    kept = one_per_group(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=repr)
    # 1 stands for 1, 2, 2; -5 for 10; the five without words all stay; so do both texts of id 7.
    assert ids == sorted([1, 3, 4, 5, None, None, 6, 7, 7, 8, 9, -5], key=repr)


def test_repeated_keeper_stays_once(spark):
    docs = spark.createDataFrame([(1, "a b c d e")] * 3 + [(2, "a b c d e")], "doc_id bigint, text string")
    assert [tuple(r) for r in one_per_group(docs).collect()] == [(1, "a b c d e")]


def test_empty(nothing):
    assert groups(nothing).count() == 0 and one_per_group(nothing).count() == 0


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (103, 100), (7, 7)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    rows = {r["node"]: r["component"] for r in components(df).collect()}
    assert rows == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 104)}}


def test_no_job_of_components_plans_a_star_twice(spark, monkeypatch):
    """The driver holds a whole job's plan; before, a round was one job of 16 joins and aggregations."""
    steps = {}

    def noted(df, name, *rest, **more):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        steps[name] = max(steps.get(name, 0), plan.count("Join ") + plan.count("HashAggregate("))
        return stored(df, name, *rest, **more)

    monkeypatch.setattr(components_module, "stored", noted)
    df = spark.createDataFrame([(k, k + 1) for k in range(20)], "a bigint, b bigint")
    assert {r["component"] for r in components(df).collect()} == {0}
    assert max(steps.values()) <= 5, steps
