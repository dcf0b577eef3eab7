"""Token counts of a unigram tokenizer by a count-only Viterbi.

An Aho-Corasick automaton lists the vocabulary pieces that end at each
character; a pass over the characters keeps, per position, the best score and
the number of pieces on the best path, nothing else. Ties follow the rule of
unigram tokenizers: of equal scores the candidate that starts first wins. A
character without a piece of its own is unknown, scored ten below the lowest
piece, and counts as its UTF-8 bytes with byte fallback, else one per run of
unknown characters.

Spaces become U+2581 and one is put before a text that is not empty. No piece
of usual vocabularies holds U+2581 after another character; then no path spans
such a place, texts are cut there and counts of short chunks are remembered.
This needs exact sums, so it is done for whole-number scores only; otherwise
whole texts are walked.

Defined results: null and empty texts have no tokens; repeated rows each get
their count; other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortforge.llm.common import text_of

SPACE, PENALTY = "▁", 10.0
MAX_KNOWN, MAX_KNOWN_CHARS = 300_000, 40
CUT = re.compile(f"(?<=[^{SPACE}])(?={SPACE})")


class Counter:
    """Counts tokens for (piece, score) pairs."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True):
        import ahocorasick
        self.tree = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.tree.add_word(piece, (len(piece), float(score)))
        self.tree.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - PENALTY
        self.byte_fallback = byte_fallback
        self.by_chunk = (all(float(s).is_integer() for _, s in pieces)
                         and not any(CUT.search(p) for p, _ in pieces))
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def walk(self, text: str) -> int:
        """Tokens of a text that is already normalised."""
        n = len(text)
        if not n:
            return 0
        best, count, open_run = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ends: list[list] = [[] for _ in range(n + 1)]
        for end, found in self.tree.iter(text):  # longest first: the earliest start first
            ends[end + 1].append(found)
        for end in range(1, n + 1):
            value = None
            single = False
            for size, score in ends[end]:
                candidate = score + best[end - size]
                if value is None or candidate > value:
                    value, pieces = candidate, count[end - size] + 1
                single = single or size == 1
            if not single:
                candidate = self.unknown + best[end - 1]
                if value is None or candidate > value:
                    value, open_run[end] = candidate, True
                    if self.byte_fallback:
                        pieces = count[end - 1] + len(text[end - 1].encode("utf-8", "surrogatepass"))
                    else:
                        pieces = count[end - 1] + (0 if open_run[end - 1] else 1)
            best[end], count[end] = value, pieces
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_chunk:
            return self.walk(SPACE + text.replace(" ", SPACE))
        if "  " in text or text[0] == " " or SPACE in text:
            chunks = [c[1:] for c in CUT.split(SPACE + text.replace(" ", SPACE))]
        else:
            chunks = text.split(" ")
        try:
            return sum(map(self.known.__getitem__, chunks))
        except KeyError:
            pass
        if len(self.known) > MAX_KNOWN:  # chunks that come again move over, the others go
            self.known, self.older = {}, self.known
        total, known = 0, self.known
        for c in chunks:
            n = known.get(c)
            if n is None:
                n = self.older.get(c)
                if n is None:
                    n = self.walk(SPACE + c)
                if len(c) <= MAX_KNOWN_CHARS:
                    known[c] = n
            total += n
        return total


_COUNTERS: dict[str, Counter] = {}


def sentencepiece_pieces(path: str) -> list[tuple[str, float]]:
    """Ordinary pieces and scores of a sentencepiece file: no unknown, control,
    unused or byte pieces."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
            if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i) or sp.is_byte(i))]


def token_count(col: Column | str, model: str, byte_fallback: bool = True) -> Column:
    """Tokens of a text under the pieces and scores of a sentencepiece file. The
    automaton is built once per worker process."""
    @F.pandas_udf("long")
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if model not in _COUNTERS:
            _COUNTERS[model] = Counter(sentencepiece_pieces(model), byte_fallback)
        counter = _COUNTERS[model]
        for part in parts:
            yield pd.Series([counter.count(t) for t in part], dtype="int64")
    return counted(text_of(col))
