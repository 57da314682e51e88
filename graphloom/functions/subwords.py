"""Counting the subword tokens of a model's vocabulary: the most likely segmentation of each word, found over a trie.

A vocabulary is a table (piece, score) of any size up to a stated bound; scores are log probabilities. Words are what white space separates, and begin
with the mark ``▁``, as in such vocabularies. Of equally likely segmentations the one of fewest pieces counts. A character that no piece
covers is a token of its own, less likely than any piece.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"
#: Pieces that a vocabulary may have, as it goes to every task.
MOST = 500_000
#: What a character outside the vocabulary scores below the least piece.
UNKNOWN = 10.0


def vocabulary(spark: SparkSession, path: str, mark: str = MARK) -> DataFrame:
    """(piece, score) of a ranked byte vocabulary (base64 and rank in each line): pieces that are text, scored by minus the logarithm of their rank.

    A piece that begins with a blank begins a word.
    """
    line = F.split("value", " ")
    rows = spark.read.text(path).select(F.unbase64(line[0]).alias("bytes"), line[1].cast("long").alias("rank"))
    text = F.when(F.is_valid_utf8(F.col("bytes").cast("string")), F.col("bytes").cast("string"))
    piece = F.when(text.startswith(" "), F.concat(F.lit(mark), F.substring(text, 2, 1000))).otherwise(text)
    return rows.select(piece.alias("piece"), (-F.log(F.col("rank") + 2)).alias("score")).where("piece <> '' and not piece rlike '\\\\s'").groupBy("piece").agg(F.max("score").alias("score"))


class SubwordCounter:
    """A counter for ``count=``: SubwordCounter(pieces)(text) is the number of tokens of a text."""

    def __init__(self, pieces: dict[str, float], mark: str = MARK):
        self.pieces, self.mark = pieces, mark
        self._trie: dict | None = None

    @classmethod
    def of(cls, table: DataFrame, mark: str = MARK, most: int = MOST) -> SubwordCounter:
        """The counter of a vocabulary table (piece, score); more than ``most`` pieces are an error."""
        rows = table.select("piece", "score").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"a vocabulary of more than {most} pieces")
        return cls({r["piece"]: float(r["score"]) for r in rows}, mark)

    def __reduce__(self):
        return type(self), (self.pieces, self.mark)

    def _built(self) -> dict:
        """The trie; the key '' holds a piece's score. Words seen are kept, as texts repeat them."""
        if self._trie is None:
            self._trie = {}
            for piece, score in self.pieces.items():
                node = self._trie
                for c in piece:
                    node = node.setdefault(c, {})
                node[""] = score
            self._low = min(self.pieces.values(), default=0.0) - UNKNOWN
            self._counted = lru_cache(200_000)(self._viterbi)
        return self._trie

    def _viterbi(self, word: str) -> int:
        best: list[tuple[float, int]] = [(0.0, 0)] + [(float("-inf"), 0)] * len(word)  # (score, minus the number of pieces) up to each place
        for i in range(len(word)):
            score, n = best[i]
            best[i + 1] = max(best[i + 1], (score + self._low, n - 1))
            node = self._trie
            for j in range(i, len(word)):
                node = node.get(word[j])
                if node is None:
                    break
                if "" in node:
                    best[j + 1] = max(best[j + 1], (score + node[""], n - 1))
        return -best[-1][1]

    def __call__(self, text: str) -> int:
        self._built()
        return sum(self._counted(self.mark + w) for w in text.split())


def n_subwords(c: Column, counter: SubwordCounter) -> Column:
    """The number of a text's tokens."""
    import pandas as pd

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: counter(s or ""))

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "int")(c)
