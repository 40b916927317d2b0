import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from plateward.llm import periodic_runs as p
from plateward.llm.queries import queries

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """All runs by comparing each word with the one a period on, for every period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        start = None
        for i in range(len(words) - q + 1):
            same = i + q < len(words) and words[i] == words[i + q]
            if same and start is None:
                start = i
            elif not same and start is not None:
                if i + q - start >= max(6, 4 * q):
                    found.setdefault((start, i + q), q)
                start = None
    return sorted((s, e - s, q) for (s, e), q in found.items())


def report(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        period = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % period] for i in range(n)]
    runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries()["op12_grammar_runs"](spark, FOLDER).collect()
    assert len(rows) == len(texts) and sum(r["n_runs"] for r in rows) > 20
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == report(r["doc_id"], texts[r["doc_id"]])


def test_random_sequences():
    rng = random.Random(3)
    for _ in range(1500):
        flat, want = [], []
        for _ in range(rng.randint(0, 4)):
            k, n = rng.choice([1, 2, 2, 3, 5]), rng.choice([0, 1, 5, 8, 20, 60])
            words = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                q = rng.randint(1, max(1, (n - a) // 3))
                words = words[:a] + [words[a + (i - a) % q] for i in range(a, n)]
            words *= rng.randint(1, 4) if rng.random() < 0.3 else 1
            want += [(s + len(flat), s + length + len(flat), q) for s, length, q in brute(words)]
            flat += [*words, -1]
        assert sorted(map(tuple, p.runs_of(np.array(flat, np.int64), 5).tolist())) == sorted(want)


def test_long_runs_take_no_quadratic_time():
    assert p.runs_of(np.append(np.zeros(300_000, np.int64), -1), 1).tolist() == [[0, 300_000, 1]]
    tiled = np.append(np.tile(np.arange(400), 700), -1)
    assert p.runs_of(tiled, 400).tolist() == [[0, 280_000, 400]]


def test_awkward(awkward, nothing):
    rows = p.searched(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[9]["runs"][0].asDict() == {"start": 0, "length": 50, "period": 1} and by_id[9]["collapsed"] == "x"
    assert (by_id[3]["n_words"], by_id[3]["runs"], by_id[3]["collapsed"]) == (0, [], "")
    assert by_id[5]["collapsed"] == "" and by_id[8]["collapsed"] == "ÄÖ é 漢字 😀 end"
    digest = p.digest(p.searched(awkward, rewrite=p.planted))
    assert digest.count() == awkward.count() and digest.where("runs_sha256 IS NULL OR collapsed_sha256 IS NULL").count() == 0
    assert p.digest(p.searched(nothing)).count() == 0
