import random
import re

from plateward.llm import longest_match as m
from plateward.llm.queries import VOCABULARY, queries

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def greedy(word, begin, inside, byte_pieces=False):
    """Number of pieces by trying every length, or None. A word that no begin piece fits starts with the bare one."""
    at = count = 0
    start = True
    while at < len(word):
        pieces = begin if start else inside
        end = next((e for e in range(min(len(word), at + 40), at, -1) if word[at:e] in pieces), None)
        if end is None and start and "" in begin:
            end = at
        elif end is None and byte_pieces:
            end, count = at + 1, count + len(word[at].encode()) - 1
        elif end is None:
            return None
        at, count, start = end, count + 1, False
    return count


def test_random_vocabularies():
    rng = random.Random(2)
    for _ in range(200):
        begin, inside = (
            {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 6))}
            for _ in range(2)
        )
        automaton = m.build(begin, inside)
        words = ["".join(rng.choice("aabbccd") for _ in range(rng.choice([1, 2, 5, 9, 60]))) for _ in range(20)]
        for word, count in zip(words, m.lengths(automaton, words)):
            want = greedy(word, begin, inside)
            assert count == (m.UNKNOWN + 1 if want is None else want)


def test_query_equals_brute_force(spark):
    begin, inside = map(set, m.read_vocabulary(VOCABULARY))
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries()["op8_longest_match"](spark, FOLDER).collect()
    assert len(rows) == len(text)
    for r in rows:
        counts = [greedy(w, begin, inside, True) for w in WORD.findall(text[r["doc_id"]])]
        assert (r["n_words"], r["n_unknown"]) == (len(counts), counts.count(None))
        assert r["n_tokens"] == sum(1 if c is None else c for c in counts)


def test_awkward(spark, awkward, nothing):
    begin, inside = ["one", "w", "Ä"], ["1", "2", "9", "Ö"]
    rows = m.token_counts(awkward, begin, inside)
    assert rows.count() == awkward.count()
    one = rows.where("doc_id = 7 AND n_words = 1").first()
    assert (one["n_tokens"], one["n_unknown"]) == (1, 0)
    assert rows.where("doc_id = 3").first()["n_tokens"] == 0
    long_word = spark.createDataFrame([(1, "w" + "1" * 100_000)], "doc_id int, text string")
    assert m.token_counts(long_word, begin, inside).first()["n_tokens"] == 100_001
    assert m.token_counts(nothing, begin, inside).count() == 0
    assert m.token_counts(awkward, [], []).where("n_tokens <> n_words OR n_unknown <> n_words").count() == 0


def raw_greedy(word, pieces):
    """Number of pieces of the marked word by trying every length; a letter without piece is its bytes."""
    text, at, count = m.SPACE + word, 0, 0
    while at < len(text):
        end = next((e for e in range(min(len(text), at + 40), at, -1) if text[at:e] in pieces), None)
        at, count = (end, count + 1) if end else (at + 1, count + m.n_bytes(text[at]))
    return count


def raw_pieces():
    model = m._model(VOCABULARY)
    known = (k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k)))
    return {model.id_to_piece(k) for k in known if not model.is_byte(k)}


def test_query_spells_every_word_by_the_raw_pieces(spark):
    pieces = raw_pieces()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in queries()["op8_longest_match"](spark, FOLDER).collect():
        assert r["n_unknown"] == 0
        assert r["n_tokens"] == sum(raw_greedy(w, pieces) for w in WORD.findall(text[r["doc_id"]]))


def test_scripts_without_pieces():
    pieces, (begin, inside) = raw_pieces(), m.read_vocabulary(VOCABULARY)
    words = ["漢字", "ሰላም" * 30, "😀x😀", "\u2581", "a\u2581b\u2581\u2581c", "<0x41>", "\U00012000", "ก็" * 5, "\ud800"]
    found = m.lengths(m.build(begin, inside, m.has_bytes(VOCABULARY)), words)
    assert found.tolist() == [raw_greedy(w, pieces) for w in words]


def test_random_vocabularies_with_bare_and_byte_pieces():
    rng = random.Random(3)
    for _ in range(300):
        some = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 4)))
        begin = {some() for _ in range(rng.randint(0, 5))} | {""}
        inside = {some() for _ in range(rng.randint(1, 6))}
        pieces = inside | {m.SPACE + name for name in begin}
        words = ["".join(rng.choice("aabbéd漢") for _ in range(rng.choice([1, 2, 5, 9, 60]))) for _ in range(20)]
        assert m.lengths(m.build(begin, inside, True), words).tolist() == [raw_greedy(w, pieces) for w in words]
        for word, count in zip(words, m.lengths(m.build(begin, inside), words)):
            want = greedy(word, begin, inside) or greedy("_" + word, {"_"}, inside)
            if word[0] not in {name[:1] for name in begin}:
                assert count == (m.UNKNOWN + 1 if want is None else want)
