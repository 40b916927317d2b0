import re

from plateward.llm import rule_ledger as r

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = {}
    for k in range(len(w) - 7):
        windows.setdefault(tuple(w[k : k + 8]), []).append(k)
    repeat = {k + j for places in windows.values() if len(places) > 1 for k in places for j in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeat),
    )


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_measurements_equal_brute_force(spark, awkward):
    texts = ["a b " * 50, "x " * 7, "x " * 8, "x " * 9, "a b c d e f g h i a b c d e f g h", "l\nl\n \n \n#"]
    docs = awkward.select("doc_id", "text").union(spark.createDataFrame([(0, t) for t in texts], "a int, b string"))
    want = sorted((str(d), *brute(t)) for d, t in docs.collect())
    assert sorted((str(d), *rest) for d, *rest in r.ledger(docs).select("doc_id", *COLUMNS).collect()) == want
    assert r.ledger(awkward).count() == awkward.count()


def test_policies_and_bits(spark):
    good = " ".join(f"word{k}" for k in range(30))
    rows = [(1, good), (2, "few"), (3, "a b " * 50), (4, good + " ####" * 10), (5, good.upper()), (6, None)]
    entries = r.ledger(spark.createDataFrame(rows, "doc_id bigint, text string"))
    kept = {x["doc_id"]: x for x in r.verdicts(entries).collect()}
    assert [kept[k]["kept_base_v1"] for k in range(1, 7)] == [True, False, False, True, True, False]
    assert [kept[k]["kept_standard_v1"] for k in range(1, 7)] == [True, False, False, False, True, False]
    assert [kept[k]["kept_standard_v2"] for k in range(1, 7)] == [True, False, False, False, False, False]
    assert kept[6]["failed"] == r.bit("few_words")


def test_ablations_equal_recounting(spark, awkward):
    entries = r.ledger(awkward)
    failed = [x["failed"] for x in entries.collect()]
    for row in r.ablations(entries).collect():
        policy = next(p for p in r.POLICIES if (p.name, p.version) == (row["policy"], row["version"]))
        rest = r.mask(policy) & ~r.bit(row["rule"])
        assert row["kept"] == sum(not f & r.mask(policy) for f in failed)
        assert row["kept_without"] == sum(not f & rest for f in failed)
        assert row["only"] == sum(not f & rest and bool(f & r.bit(row["rule"])) for f in failed)
    both = r.union_of_failures(entries).first()
    assert both["anywhere"] & r.bit("few_words") and both["everywhere"] == 0


def test_empty(nothing):
    assert r.ledger(nothing).count() == 0
    assert {x["kept"] for x in r.ablations(r.ledger(nothing)).collect()} == {0}
