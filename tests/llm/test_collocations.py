import random
import re
from collections import Counter

import numpy as np
import pytest

from plateward.llm import collocations as c, hash_filter

FOLDER = "/root/testdata/sf0.001"
LOWER = {k: k + 32 for k in range(65, 91)}


def brute(rows, support, longest=3, percent=50, most=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                f.update((lang or "und", *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= support}
    dropped = set()
    for p, a in candidates.items():
        for size in range(3, len(p)):
            for i in range(1, len(p) - size + 2):
                part = (p[0], *p[i : i + size - 1])
                if 100 * a >= percent * f[part]:
                    dropped.add(part)
    scored = []
    for p, a in candidates.items():
        if p not in dropped:
            cuts = [(f[p[:k]], f[(p[0], *p[k:])], k) for k in range(2, len(p))]
            low, _, left, right = min((1000000 * a * a // (x * y), k, x, y) for x, y, k in cuts)
            scored.append((p[0], -low, -a, " ".join(p[1:]).encode(), left, right))
    out, rank = [], Counter()
    for lang, low, a, phrase, left, right in sorted(scored):
        rank[lang] += 1
        if rank[lang] <= most:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -low))
    return out


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("support, longest, shards, most", [(10, 3, 4, 2000), (3, 4, 2, 50), (2, 3, 5, 7), (7, 2, 1, 2000)])
def test_equals_brute_force(spark, support, longest, shards, most):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(7)
    given = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    found = c.collocations(docs, support, longest, shards, most=most)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows_of(found) == sorted(brute(given, support, longest, most=most))


def test_random_words(spark):
    rng = random.Random(5)
    words = ["a", "B", "é", "😀", "\x1c", "\x00", "x-y", "A.", "a\tb", "c d", ",", "\n", "\x0b"]
    given = [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))), rng.choice(["en", None, "de"])) for _ in range(150)]
    docs = spark.createDataFrame(given, "text string, lang string").repartition(5)
    assert rows_of(c.collocations(docs, 5)) == sorted(brute(given, 5))


def test_products_beyond_64_bits(spark):
    big = 2_000_000_000_000
    rows = spark.createDataFrame([(big, big, big + 1)], "a bigint, l bigint, r bigint")
    found = rows.select(c.score(rows["a"], rows["l"], rows["r"])).first()[0]
    assert found == 1000000 * big * big // (big * (big + 1))


def test_filter_loses_no_hash():
    rng = np.random.default_rng(1)
    hashes, counts = hash_filter.counted(rng.integers(0, 1 << 48, 5000, dtype=np.uint64), None)
    batch = hash_filter.blocks(hashes, counts * 3, 16)
    again = [hash_filter.unpacked(b) for b in batch["block"].to_pylist()]
    assert np.array_equal(np.concatenate([h for h, _ in again]), hashes)
    assert np.array_equal(np.concatenate([n for _, n in again]), counts * 3)


def test_awkward(awkward, nothing):
    given = [(r["text"], r["lang"]) for r in awkward.select("text", "lang").collect()]
    assert rows_of(c.collocations(awkward, 3)) == sorted(brute(given, 3))
    assert c.collocations(nothing).count() == 0
