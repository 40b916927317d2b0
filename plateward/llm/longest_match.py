"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie with two roots, for pieces that begin a word and for
pieces that continue one. Each node has a failure link and, computed in advance,
how many pieces following it pops. So one pass over the letters of a word gives
the length of its greedy longest-match split without building any piece.

The automaton is arrays. All new words of a batch run through it together, one
letter at a time; counts of words seen before are kept in a bounded table.

A vocabulary may have the bare begin piece, the empty name among those that begin
a word: words that no other piece begins start with it. It may have byte pieces: a
letter that no piece begins then counts as the bytes of its UTF-8 form. A word
that the vocabulary still cannot spell counts as one unknown piece. Words are
split at ASCII white space; letters are taken as they are.

Defined results: NULL and empty texts have no words and no pieces. Words of any
length are matched whole. Repeated rows are counted each. Empty tables give
empty results. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plateward.llm.common import portions

SPACE = "▁"
NOWHERE = -1
BEGIN, CONTINUE = 0, 1
# Words up to this length run through the automaton together, longer ones alone.
TOGETHER = 48
KNOWN_WORDS = 200_000
PORTION = 1 << 21
UNKNOWN = 1 << 40


def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def read_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin a word and pieces that continue one, of a sentence-piece model file.

    A piece with the begin mark also continues words whose text holds that mark itself.
    """
    model = _model(path)
    begin, inside = [], []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_control(k) or model.is_unknown(k) or model.is_byte(k):
            continue
        if piece.startswith(SPACE):
            begin.append(piece[1:])
        inside.append(piece)
    return begin, inside


def has_bytes(path: str) -> bool:
    """Whether a sentence-piece model file has a piece for every byte."""
    model = _model(path)
    return sum(model.is_byte(k) for k in range(model.get_piece_size())) == 256


class Automaton(NamedTuple):
    """Transitions as sorted keys ``node * letters + letter``, failure links and their pops."""

    alphabet: np.ndarray
    keys: np.ndarray
    targets: np.ndarray
    fail: np.ndarray
    pops: np.ndarray
    byte_pieces: bool


def n_bytes(letter: str) -> int:
    return len(letter.encode("utf-8", "surrogatepass"))


def build(begin: Iterable[str], inside: Iterable[str], byte_pieces: bool = False) -> Automaton:
    """The automaton of a vocabulary; its size is that of the vocabulary's letters."""
    children: list[dict[str, int]] = [{}, {}]
    piece = [0, 0]  # how many pieces a node stands for, 0 if it is none
    for root, names in ((BEGIN, begin), (CONTINUE, inside)):
        for name in names:
            node = root
            for letter in name:
                if letter not in children[node]:
                    children[node][letter] = len(children)
                    children.append({})
                    piece.append(0)
                node = children[node][letter]
            if name or root == BEGIN:
                piece[node] = 1
    if byte_pieces:
        piece[BEGIN] = piece[BEGIN] or n_bytes(SPACE)
        for letter, node in children[CONTINUE].items():
            piece[node] = piece[node] or n_bytes(letter)
    fail, pops = [NOWHERE] * len(children), [0] * len(children)
    if piece[BEGIN]:
        fail[BEGIN], pops[BEGIN] = CONTINUE, piece[BEGIN]
    level = [BEGIN, CONTINUE]
    while level:
        below = []
        for parent in level:
            for letter, node in children[parent].items():
                below.append(node)
                if piece[node]:
                    fail[node], pops[node] = CONTINUE, piece[node]
                    continue
                at, popped = fail[parent], pops[parent]
                while at != NOWHERE and letter not in children[at]:
                    popped += pops[at]
                    at = fail[at]
                if at != NOWHERE:
                    fail[node], pops[node] = children[at][letter], popped
                elif byte_pieces:
                    fail[node], pops[node] = CONTINUE, popped + n_bytes(letter)
        level = below
    alphabet = sorted({letter for edges in children for letter in edges})
    index = {letter: k for k, letter in enumerate(alphabet)}
    edges = sorted(
        (node * len(alphabet) + index[letter], target)
        for node, out in enumerate(children)
        for letter, target in out.items()
    )
    return Automaton(
        np.array([ord(letter) for letter in alphabet], np.int64),
        np.array([key for key, _ in edges], np.int64),
        np.array([target for _, target in edges], np.int64),
        np.array(fail, np.int64),
        np.array(pops, np.int64),
        byte_pieces,
    )


def _go(a: Automaton, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The child of each node by its letter, or nowhere."""
    wanted = nodes * len(a.alphabet) + letters
    at = np.minimum(np.searchsorted(a.keys, wanted), len(a.keys) - 1)
    return np.where((a.keys[at] == wanted) & (letters >= 0), a.targets[at], NOWHERE)


def _letters(a: Automaton, points: np.ndarray) -> np.ndarray:
    """Places of code points in the alphabet, -1 for strangers."""
    at = np.minimum(np.searchsorted(a.alphabet, points), len(a.alphabet) - 1)
    return np.where(a.alphabet[at] == points, at, -1)


def lengths(a: Automaton, words: list[str]) -> np.ndarray:
    """Pieces of each word; ``UNKNOWN + 1`` for a word that cannot be spelled."""
    counts = np.zeros(len(words), np.int64)
    if not len(a.keys):
        if a.byte_pieces:
            return np.array([a.pops[BEGIN] + n_bytes(w) for w in words], np.int64)
        return counts + UNKNOWN + 1
    sizes = np.array([len(w) for w in words], np.int64)
    order = np.argsort(-sizes, kind="stable")
    together = order[sizes[order] <= TOGETHER]
    groups = [np.array([k]) for k in order[: len(order) - len(together)]]
    if len(together):
        groups.append(together)
    for group in groups:
        longest = int(sizes[group[0]])
        # Fixed-width rows of code points, the longest word first.
        text = "".join(words[k].ljust(longest, "\0") for k in group)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = _letters(a, points.astype(np.int64)).reshape(len(group), longest)
        points = points.reshape(len(group), longest)
        width = sizes[group]
        node, count = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        for k in range(longest):
            here = np.arange(np.searchsorted(-width, -k, side="left"))  # words longer than k
            here = here[node[here] != NOWHERE]
            while len(here):
                to = _go(a, node[here], letters[here, k])
                stuck = to == NOWHERE
                node[here[~stuck]] = to[~stuck]
                here = here[stuck]
                count[here] += a.pops[node[here]]
                node[here] = a.fail[node[here]]
                lost = node[here] == NOWHERE
                if a.byte_pieces:
                    spelled = points[here[lost], k]
                    count[here[lost]] += 1 + (spelled >= 0x80) + (spelled >= 0x800) + (spelled >= 0x10000)
                    node[here[lost]] = CONTINUE
                here = here[~lost]
        open_ = np.flatnonzero((node != NOWHERE) & (node != CONTINUE))
        while len(open_):
            count[open_] += a.pops[node[open_]]
            node[open_] = a.fail[node[open_]]
            open_ = open_[(node[open_] != NOWHERE) & (node[open_] != CONTINUE)]
        counts[group] = np.where(node == NOWHERE, UNKNOWN + 1, count)
    return counts


def token_counts(
    docs: DataFrame,
    begin: list[str],
    inside: list[str],
    id_column: str = "doc_id",
    text_column: str = "text",
    byte_pieces: bool = False,
) -> DataFrame:
    """Per document: id, ``n_words``, ``n_tokens`` and ``n_unknown``, the words that count as one unknown piece."""
    shared = docs.sparkSession.sparkContext.broadcast(build(begin, inside, byte_pieces))  # as large as the vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = shared.value, {}
        for batch in batches:
            texts, sizes, sums = batch["text"].to_pylist(), [], []
            for start, end in portions(texts, PORTION):
                # bytes.split() splits at ASCII white space only.
                rows = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts[start:end]]
                used = set().union(*rows)
                new = [word for word in used if word not in known]
                if len(known) + len(new) > KNOWN_WORDS:
                    known, new = {}, list(used)
                found = lengths(automaton, [w.decode("utf-8", "surrogatepass") for w in new])
                known.update(zip(new, found.tolist()))
                sizes += map(len, rows)
                sums += (sum(map(known.__getitem__, row)) for row in rows)
            sums = np.array(sums, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(sizes, pa.int64()),
                    pa.array(sums % UNKNOWN, pa.int64()),
                    pa.array(sums // UNKNOWN, pa.int64()),
                ],
                names=["id", "n_words", "n_tokens", "n_unknown"],
            )

    given = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = dict(given.dtypes)["id"]
    counted = given.mapInArrow(count, f"id {kind}, n_words bigint, n_tokens bigint, n_unknown bigint")
    return counted.withColumnRenamed("id", id_column)
