import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from plateward.llm import suffix_dedup as d, suffix_merge as m
from plateward.llm.queries import queries

FOLDER = "/root/testdata/sf0.001"


def brute(texts, length):
    """(bytes, removed, spans, hash of the rest) by counting every string."""
    data = [(t or "").encode() if not isinstance(t, bytes) else t for t in texts]
    starts = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        covered = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - length + 1):
            if starts[t[i : i + length]] > 1:
                covered[i] += 1
                covered[i + length] -= 1
        gone = np.cumsum(covered)[: len(t)] > 0
        spans = int(np.sum(np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1))
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def in_one_process(texts, length, gram, portion, hot=(), piece=d.PIECE):
    """The operator's steps without Spark, with portions of so many texts: removed spans of each text."""
    grams, hot = Counter(), np.array(sorted(hot), np.uint64)
    parts = [[k for k in range(a, min(a + portion, len(texts))) if len(texts[k]) >= length] for a in range(0, len(texts), portion)]
    runs, several = [], []
    for part in parts:
        found, _ = d.anchors([texts[k] for k in part], length, gram, hot, piece) if part else (None, None)
        grams.update(found.gram.tolist() if part else [])
    for part in filter(None, parts):
        chosen = [texts[k] for k in part]
        found, joined = d.anchors(chosen, length, gram, hot, piece)
        starts = np.cumsum([0, *map(len, chosen)])
        keys, lefts, about, seen = [], [], [], {}
        for a, first, last, g in zip(*(c.tolist() for c in found)):
            if grams[g] > 1:
                t = int(np.searchsorted(starts, a, side="right")) - 1
                context, row = joined[first : last + length], part[t]
                k = seen.setdefault((context, a - first), len(keys))
                if k == len(keys):
                    keys.append(context[a - first :])
                    lefts.append(context[: a - first][::-1])
                    about.append([0, row, a - int(starts[t])])
                else:
                    about[k][0] = 1
                    several.append((*about[k][1:], row, a - int(starts[t])))
        if keys:
            runs.append(m.unpacked(m.packed(m.run_of(keys, lefts, np.array(about, np.int64)))))
    if not runs:
        return {}
    rows = np.array([r[1:] for r in d.found_repeats(runs, [0] * len(runs), length, gram)], np.int64).reshape(-1, 4)
    return d._spans(rows, np.array(several, np.int64).reshape(-1, 4))


def copied_texts(rng):
    """Texts over few letters, with copies, edits, shared passages and periods."""
    letters = rng.choice([b"ab", b"abcd", bytes(range(97, 123))])
    some = lambda n: bytes(rng.choice(letters) for _ in range(n))
    passages = [some(rng.randint(15, 60)) for _ in range(3)]
    texts = []
    for _ in range(rng.randint(1, 12)):
        kind = rng.random()
        if kind < 0.25 and texts:
            base = bytearray(rng.choice(texts))
            for _ in range(rng.randint(0, 2)):
                if base:
                    base[rng.randrange(len(base))] = rng.choice(letters)
            texts.append(bytes(base))
        elif kind < 0.5:
            texts.append(some(rng.randint(0, 50)) + rng.choice(passages) + some(rng.randint(0, 50)))
        elif kind < 0.65:
            texts.append(some(rng.randint(1, 6)) * rng.randint(1, 30) + some(rng.randint(0, 20)))
        else:
            texts.append(some(rng.randint(0, 120)))
    return texts


def test_random_texts_equal_brute_force():
    rng = random.Random(11)
    removed = 0
    for k in range(500):
        texts = copied_texts(rng)
        gram = rng.choice([1, 4, 8, 20])
        hot = []
        if k % 3 == 0:
            found, _ = d.anchors([t for t in texts if len(t) >= 20] or [b"x" * 20], 20, gram, np.zeros(0, np.uint64))
            hot = {int(h) >> 16 for h in found.gram.tolist()[::2]}
        spans = in_one_process(texts, 20, gram, rng.randint(1, 5), hot, rng.choice([7, 64, d.PIECE]))
        want = brute(texts, 20)
        for t, text in enumerate(texts):
            mine = spans.get(t, [])
            assert (sum(e - s for s, e in mine), len(mine)) == want[t][1:3]
        removed += sum(w[1] for w in want)
    assert removed > 10_000


def test_merge_orders_strings_and_gives_common_prefixes():
    rng = random.Random(4)
    for _ in range(200):
        runs = []
        for _ in range(rng.randint(1, 9)):
            keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 12))]
            runs.append(m.unpacked(m.packed(m.run_of(keys, keys, np.zeros((len(keys), 1), np.int64)))))
            assert runs[-1].lefts == runs[-1].keys
        found = [(runs[r].keys[k], shared) for r, k, shared in m.merged(runs)]
        assert [k for k, _ in found] == sorted(k for r in runs for k in r.keys)
        for (a, _), (b, shared) in zip(found, found[1:]):
            assert shared == m.common(a, b)


def test_equal_strings_choose_one_place():
    rng = random.Random(6)
    passage = bytes(rng.randrange(256) for _ in range(900))
    none = np.zeros(0, np.uint64)
    texts = [bytes(rng.randrange(256) for _ in range(n)) + passage + b"tail" * 90 for n in (0, 3, 5000, 70_001)]
    for piece in (1 << 10, 1 << 16):
        sets = []
        for text in texts:
            found, joined = d.anchors([text], d.LENGTH, d.GRAM, none, piece)
            at = text.index(passage)
            chosen = [(int(p) - at, int(f) - at, int(e) - at) for p, f, e in zip(found.place, found.first, found.last)]
            # Of each string inside the passage, the place it chose.
            sets.append({w: p for p, f, e in chosen for w in range(max(f, 0), min(e, 500) + 1)})
            assert joined == text
        assert len(sets[0]) == 501 and sets[0] == sets[1] == sets[2] == sets[3]


@pytest.mark.parametrize("hot_above", [d.HOT, 3])
def test_operator_equals_brute_force(spark, hot_above):
    rng = random.Random(8)
    texts = [t for _ in range(30) for t in copied_texts(rng)]
    rows = [(k, t.decode()) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(6)
    found = {r[0]: tuple(r[1:]) for r in d.digest(d.without_repeats(docs, 20, 8, hot_above=hot_above)).collect()}
    assert [found[k] for k, _ in rows] == brute(texts, 20)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = {r[0]: tuple(r)[1:] for r in queries()["op11_suffix_merge"](spark, FOLDER).collect()}
    want = brute([r["text"] for r in rows], 400)
    assert [found[r["doc_id"]] for r in rows] == want and sum(w[1] for w in want) > 1000


def test_awkward(awkward, nothing):
    rows = awkward.select("doc_id", "text").collect()
    found = d.digest(d.without_repeats(awkward, 20, 8))
    have = sorted(tuple(r)[1:] for r in found.collect())
    assert have == sorted(brute([r["text"] for r in rows], 20))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert d.digest(d.without_repeats(nothing)).count() == 0
