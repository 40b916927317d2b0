import hashlib
import random
import re

import numpy as np

from plateward.llm import decontamination as d
from plateward.llm.fm_index import FMIndex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    phrases = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            phrases.setdefault(tuple(w[k : k + 10]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for phrase, owners in phrases.items():
            for k in range(len(w) - len(phrase) + 1):
                if tuple(w[k : k + len(phrase)]) == phrase:
                    hit.update(range(k, k + len(phrase)))
                    found |= owners
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def pairs(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_index_finds_every_place():
    rng = random.Random(3)
    for _ in range(20):
        sequence = np.array([rng.randrange(4) for _ in range(200)] + [0])
        index = FMIndex(sequence, 3)
        pattern = np.array([[rng.randrange(1, 4) for _ in range(3)]])
        low, high = index.search(pattern, np.array([3]))
        found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
        assert found == [k for k in range(199) if (sequence[k : k + 3] == pattern[0]).all()]


def test_occurrences_with_small_shards():
    rng = random.Random(5)
    for trial in range(30):
        size = rng.choice([2, 5, 40])
        rows = []
        for item in range(4):
            w = [f"v{rng.randrange(size)}" for _ in range(rng.choice([1, 3, 10, 14]))]
            rows += [
                {"phrase": p, "item": str(item)} for p in {" ".join(w[k : k + 10]) for k in range(max(1, len(w) - 9))}
            ]
        block = d.block_of(rows)
        stream = np.array([rng.randrange(len(block.vocabulary) + 1) for _ in range(250)])
        start, phrase = d.occurrences(stream, block, most=rng.choice([21, 1000]))
        want = {
            (k, p)
            for p, n in enumerate(block.lengths)
            for k in range(len(stream) - n + 1)
            if (stream[k : k + n] == block.patterns[p, :n]).all()
        }
        assert set(zip(start.tolist(), phrase.tolist())) == want


def test_report_equals_brute_force(awkward, benchmark):
    want = brute(pairs(awkward, "doc_id", "text"), pairs(benchmark, "item_id", "text"))
    for block_bytes in (d.BLOCK_BYTES, 300):  # one pass and several
        scans = d.scanned(awkward, benchmark, block_bytes=block_bytes)
        assert sorted(pairs(d.report(scans), "*"), key=repr) == want


def test_spans_and_removal(spark, benchmark):
    text = "Ja: TWO, words! nein two  words-two"
    docs = spark.createDataFrame([(1, text, "k"), (2, "clean", None)], "doc_id bigint, text string, chars string")
    scans = d.scanned(docs, benchmark)
    row = scans.where("row.doc_id = 1").first()
    assert [tuple(s) for s in row["spans"]] == [(1, 3), (4, 6)]
    assert [text[a:b] for a, b in row["chars"]] == ["TWO, words", "two  words"]
    assert row["items"] == ["2"]
    assert sorted(pairs(d.without_spans(scans), "*")) == [(1, "Ja: ! nein -two", "k"), (2, "clean", None)]
    assert pairs(d.clean(scans), "*") == [(2, "clean", None)]


def test_empty_tables(nothing, awkward, benchmark):
    assert d.report(d.scanned(nothing, benchmark)).count() == 0
    scans = d.scanned(awkward, benchmark.limit(0))
    assert d.clean(scans).count() == awkward.count() and d.clean(scans).columns == awkward.columns
