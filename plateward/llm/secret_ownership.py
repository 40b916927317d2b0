"""Secret scan with corpus-wide ownership of what it finds.

A scan of each text gives spans of three base kinds and, besides, random-looking
tokens. Every found value is a candidate. Candidates are counted over the whole
corpus by distinct repositories and owners: what many owners share is an example
that was copied around; what looks random and belongs to few owners is probably
live, in however many repositories of theirs. The random-looking tokens of that
second sort become spans of a fourth kind.

Values are compared by 64-bit hash and never leave the scan in clear.

Defined results: a NULL text is empty. A candidate without owner counts NULL as
one owner of its own. Repeated rows are separate repositories if they have no id,
one repository otherwise; each keeps its row. A text of any length is scanned whole. Empty tables give empty results.
Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from plateward.session import stored

KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# A run that is long enough is the same match whether short runs are skipped or dropped.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
ASSIGN_LENGTH = 8
# As whole parts of a value: runs of letters or of digits.
PLACEHOLDER = re.compile(
    r"(?ai:(?<![a-z])(?:example|sample|dummy|changeme|placeholder|your|test|x{4,}|abcdef)(?![a-z])|(?<!\d)1234567\d*)"
)

# Owned: at most so many owners hold the value.
MAX_OWNERS = 2
MIN_ENTROPY = 3.0

FOUND = pa.struct(
    [
        ("kind", pa.int32()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("value", pa.int64()),
        ("random", pa.bool_()),
    ]
)
FOUND_TYPE = "array<struct<kind:int,start:bigint,end:bigint,value:bigint,random:boolean>>"


def entropy(value: str) -> float:
    """Bits per character of a string's own letter counts."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_random(value: str) -> bool:
    return entropy(value) >= MIN_ENTROPY and not PLACEHOLDER.search(value)


def mixed(value: str) -> bool:
    """A letter and a digit, as in encoded random bytes. Whether it is a secret, owners decide."""
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value)


def hashed(value: str) -> int:
    unsigned = xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"))
    return unsigned - (1 << 64) if unsigned >> 63 else unsigned


def find(text: str) -> list[tuple[int, int, int, int, bool]]:
    """(kind, start, end, hash of the value, looks random), in the order of the text."""
    found = [
        (0, m.start(), m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LENGTH
    ]
    found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    tokens = [m for m in TOKEN.finditer(text) if mixed(m[0]) and looks_random(m[0])]
    if tokens:
        base = sorted((start, end) for _, start, end, _ in found)
        starts, reach = [s for s, _ in base], list(accumulate((e for _, e in base), max))
        for m in tokens:
            before = bisect_left(starts, m.end())
            if not before or reach[before - 1] <= m.start():
                found.append((3, m.start(), m.end(), m[0]))
    found.sort(key=lambda f: (f[1], f[0]))
    return [(k, s, e, hashed(v), k == 3 or looks_random(v)) for k, s, e, v in found]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ("kind", "start", "end", "value", "random")
    for batch in batches:
        rows = [[dict(zip(keys, f)) for f in find(text or "")] for text in batch["text"].to_pylist()]
        arrays = [batch["id"], batch["owner"], pa.array(rows, pa.list_(FOUND))]
        yield pa.RecordBatch.from_arrays(arrays, names=["id", "owner", "found"])


def scanned(docs: DataFrame, id_column: str, owner_column: str, text_column: str) -> DataFrame:
    """One row per document: ``row``, ``id``, ``owner``, ``found``. No text."""
    given = docs.select(
        F.col(id_column).alias("id"), F.col(owner_column).alias("owner"), F.col(text_column).alias("text")
    )
    types = dict(given.dtypes)
    found = given.mapInArrow(_scan, f"id {types['id']}, owner {types['owner']}, found {FOUND_TYPE}")
    return found.withColumn("row", F.monotonically_increasing_id())


def ownership(scans: DataFrame) -> DataFrame:
    """Per value: distinct ``repositories`` and ``owners`` that hold it, and its ``verdict``.

    Distinct by steps, each a partial sum before its shuffle, so that a value
    in a third of all documents is spread over all tasks.
    """
    repository = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("row "), F.col("row").cast("string")))
    held = (
        scans.select("owner", repository.alias("repository"), F.explode("found").alias("f"))
        .select("owner", "repository", F.col("f.value").alias("value"), F.col("f.random").alias("random"))
        .groupBy("value", "owner", "repository")
        .agg(F.max("random").alias("random"))
        .groupBy("value", "owner")
        .agg(F.count("*").alias("repositories"), F.max("random").alias("random"))
        .groupBy("value")
        .agg(
            F.sum("repositories").alias("repositories"),
            F.count("*").alias("owners"),
            F.max("random").alias("random"),
        )
    )
    few = F.col("owners") <= MAX_OWNERS
    verdict = F.when(~few, "copied").when(F.col("random"), "live").otherwise("weak")
    return held.withColumn("verdict", verdict)


def spelled(found: Column) -> Column:
    """``kind:start:end`` of (start, kind, end) structs, comma-joined in their order."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    parts = F.transform(
        F.sort_array(found),
        lambda f: F.concat_ws(":", F.get(kinds, f["kind"]), f["start"].cast("string"), f["end"].cast("string")),
    )
    return F.array_join(parts, ",")


def secrets(
    docs: DataFrame, id_column: str = "doc_id", owner_column: str = "source", text_column: str = "text"
) -> DataFrame:
    """Per document: counts and digest of the base spans, ``spans`` of all kinds, and verdict counts."""
    scans = stored(scanned(docs, id_column, owner_column, text_column), "secret-scans")
    holding = scans.where(F.size("found") > 0)
    candidates = holding.select("row", F.explode("found").alias("f")).select("row", "f.*")
    place = F.struct("start", "kind", "end")
    judged = (
        candidates.join(ownership(holding).select("value", "verdict"), "value")
        .groupBy("row")
        .agg(
            F.collect_list(F.when((F.col("kind") < 3) | (F.col("verdict") == "live"), place)).alias("all"),
            F.count_if(F.col("verdict") == "live").alias("n_live"),
            F.count_if(F.col("verdict") == "copied").alias("n_copied"),
        )
    )
    count = lambda k: F.size(F.filter("found", lambda f: f["kind"] == k)).cast("bigint")
    base = F.transform(
        F.filter("found", lambda f: f["kind"] < 3), lambda f: F.struct(f["start"], f["kind"], f["end"])
    )
    return scans.join(judged, "row", "left").select(
        F.col("id").alias(id_column),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(spelled(base), 256).alias("base_sha256"),
        F.coalesce(spelled(F.col("all")), F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )
