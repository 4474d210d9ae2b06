"""Token counts without tokens: Viterbi over a unigram vocabulary that carries score and count only."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAP = "▁"
UNKNOWN_PENALTY = 10.0
# Words whose counts a task remembers.
MEMO = 400_000


def load_vocabulary(model_path: str) -> dict[str, float]:
    """Pieces and scores of a sentencepiece model, without control, unknown, unused and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
    return {sp.id_to_piece(i): sp.get_score(i) for i in plain}


class Counter:
    """Counts the pieces of the best segmentation.

    The best score at each position is that of a piece ending there plus the best score at its start. An Aho-Corasick
    automaton names all pieces that end at a position, the longest first; a later one replaces the best only if its score is
    strictly larger, so the longest of equally good pieces stays, as in the tokenizer. A character that is no piece of its
    own may also be unknown: the lowest score less a penalty, compared last, and as many tokens as it has UTF-8 bytes.
    """

    def __init__(self, vocabulary: dict[str, float]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.items():
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary:
            self.automaton.make_automaton()
        self.unknown = min(vocabulary.values(), default=0.0) - UNKNOWN_PENALTY
        self.single = {p for p in vocabulary if len(p) == 1}
        # Where no piece goes on after a gap, nor over a character that no piece has, texts fall apart into independent words.
        apart = not any(GAP in p.lstrip(GAP) for p in vocabulary)
        alone = not any("\n" in p for p in vocabulary)
        word = f"{GAP}*[^{GAP}{'\n' if alone else ''}]+|{GAP}+" + ("|\n" if alone else "")
        self.words = re.compile(word) if apart and all(float(s).is_integer() for s in vocabulary.values()) else None
        self.memo: dict[str, tuple[int, float]] = {}

    def best(self, text: str) -> tuple[int, float]:
        """(pieces, score) of one stretch of text."""
        n = len(text)
        score, count = [0.0] + [None] * n, [0] * (n + 1)
        found = self.automaton.iter(text) if len(self.automaton) else iter(())
        match = next(found, None)
        for end in range(1, n + 1):
            best, pieces = None, 0
            while match is not None and match[0] == end - 1:
                size, own = match[1]
                total = score[end - size] + own
                if best is None or total > best:
                    best, pieces = total, count[end - size] + 1
                match = next(found, None)
            char = text[end - 1]
            if char not in self.single:
                total = score[end - 1] + self.unknown
                if best is None or total > best:
                    best, pieces = total, count[end - 1] + len(char.encode("utf-8", "replace"))
            score[end], count[end] = best, pieces
        return count[n], score[n]

    def count(self, text: str | None) -> tuple[int, float]:
        """(pieces, score) of a text: spaces as gaps, one gap in front; an empty text has none."""
        if not text:
            return 0, 0.0
        marked = GAP + text.replace(" ", GAP)
        if self.words is None:
            return self.best(marked)
        pieces, score, memo = 0, 0.0, self.memo
        for w in self.words.findall(marked):
            got = memo.get(w)
            if got is None:
                got = self.best(w)
                if len(w) <= 64:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[w] = got
            pieces += got[0]
            score += got[1]
        return pieces, score


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens and score (the best segmentation's), over whole texts and without a shuffle.

    Null and empty texts have no tokens and score 0. Null ids and repeated rows are counted like any row. An empty table
    gives an empty result; other columns are ignored. `model_path` must be readable by the tasks.
    """

    @F.pandas_udf("n long, score double")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = Counter(load_vocabulary(model_path))
        for b in batches:
            yield pd.DataFrame([counter.count(t) for t in b], columns=["n", "score"])

    got = docs.select(F.col(id_col).alias("__id"), count(F.col(text_col).cast("string")).alias("__c"))
    return got.select(F.col("__id").alias(id_col), F.col("__c.n").alias("n_tokens"), F.col("__c.score").alias("score"))
