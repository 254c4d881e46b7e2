"""Token counts of a unigram tokenizer without building the tokens.

An Aho-Corasick automaton lists every vocabulary piece that ends at each position; the dynamic
programme carries, for each position, the best score and its number of pieces. Rules taken over from
the tokenizer library's unigram model with a space marker: a piece is preferred only if its score is
strictly higher, so among equals the one that starts first (the longest) wins; a character that no
one-character piece covers may stand alone at ten below the lowest score; such characters in a row
form one unknown piece, which counts its UTF-8 bytes if all 256 byte pieces exist, else one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The marker that stands for a space and begins a word, and what an unknown character costs: fixed by the format.
SPACE, UNKNOWN_PENALTY = "▁", 10.0
#: Words a worker remembers, and the longest it remembers (bounds its memory).
CACHE_ENTRIES, CACHE_LENGTH = 500_000, 64


class Counter(dict):
    """Word → number of pieces."""

    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        import ahocorasick

        super().__init__()
        self.old: dict[str, int] = {}
        pieces = dict(reversed(vocabulary))  # of equal pieces the first counts
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        self.by_bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))

    def count(self, word: str) -> int:
        """Best segmentation's piece count; time and memory follow the word's length."""
        n = len(word)
        best: list[float] = [0.0] * (n + 1)
        pieces = [0] * (n + 1)
        open_run = [False] * (n + 1)  # the last piece is unknown
        matches = self.automaton.iter(word)
        end, piece = next(matches, (n, None))
        single, by_bytes = self.single, self.by_bytes
        for at in range(n):
            score = None
            while end == at:  # longest first
                length, own = piece
                start = at + 1 - length
                if score is None or best[start] + own > score:
                    score, parent = best[start] + own, start
                end, piece = next(matches, (n, None))
            known = True
            if word[at] not in single and (score is None or best[at] + self.unknown > score):
                score, parent, known = best[at] + self.unknown, at, False
            best[at + 1] = score
            if known:
                pieces[at + 1] = pieces[parent] + 1
            else:
                size = len(word[at].encode()) if by_bytes else not open_run[at]
                pieces[at + 1] = pieces[at] + size
                open_run[at + 1] = True
        return pieces[n]

    def __missing__(self, word: str) -> int:
        n = self.old.get(word)
        if n is None:
            n = self.count(word)
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.old = dict(self)
                self.clear()
            self[word] = n
        return n

    def total(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(SPACE, " ").split(" ")
        if not words[0]:
            del words[0]  # the text begins with a space, so no marker is put before it
        return sum(map(self.__getitem__, [SPACE + w for w in words]))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a vocabulary file; a path on every machine."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size()))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(list(vocabulary(path)))


def count_tokens(docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """Adds ``name`` (long) to all columns; null and empty texts have 0 tokens.

    Rows are independent: repeated rows stay repeated, an empty table stays empty; a column already
    called ``name`` is replaced and the others pass through.
    """

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        total = counter(path).total
        return pa.array([total(t.as_py() or "") for t in texts], pa.int64())

    return docs.withColumn(name, run(F.col(text)))


def by_row(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, n_tokens and n_chars."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = counter(path).total
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            counts, sizes = [total(t) for t in texts], [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens", "n_chars"]
            )

    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_chars long")
