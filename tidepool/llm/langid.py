"""Language identification by rank-order n-gram profiles and out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import extend, map_texts, plus

#: n-grams of 1 to MAX_N letters with word edges, and how many ranks a profile and a document have.
MAX_N, RANKS = 3, 300
UNKNOWN = "und"
#: A partition's counts go out when they hold so many different n-grams.
FLUSH = 500_000

_B, _NONE = np.uint64(21), np.uint64(0x1FFFFF)
_letters: dict[str, np.ndarray] = {}


def _letter_table() -> np.ndarray:
    if "t" not in _letters:
        t = np.zeros(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            if chr(c).isalpha():
                t[c] = c
        _letters["t"] = t
    return _letters["t"]


def _codes(text: str) -> np.ndarray:
    """Lower-case letters as code points, every run of other characters as one 0, a 0 at both ends."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    c = _letter_table()[cp]
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
    return np.concatenate((np.zeros(1, np.uint32), c[keep], np.zeros(1, np.uint32))).astype(np.uint64)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams and their counts, of a whole text. 21 bits a character, 0 for a word edge, 0x1FFFFF where an n-gram is shorter."""
    c = _codes(text)
    one = c[c != 0]
    if not len(one):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    two = c[:-1] << _B | c[1:]
    three = two[:-1] << _B | c[2:]
    every = np.concatenate((_NONE << (_B + _B) | _NONE << _B | one, _NONE << (_B + _B) | two, three[c[1:-1] != 0]))
    return np.unique(every.astype(np.int64), return_counts=True)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    g, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return g, np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def top_ranks(g: np.ndarray, n: np.ndarray, k: int = RANKS) -> np.ndarray:
    """The k most frequent n-grams, most frequent first, ties by n-gram."""
    return g[np.lexsort((g, -n))[:k]]


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", ranks: int = RANKS) -> DataFrame:
    """(lang, rank, gram): the most frequent n-grams of all texts of each language; at most `ranks` rows a language.

    Rows with a null text or language teach nothing. Counts merge inside each
    partition and again before the shuffle on (lang, gram), so a language that
    holds most rows is spread like any other.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out(lang: str) -> pa.RecordBatch:
            g, n = _merge(held.pop(lang))
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)], ["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                g, n = grams(text.as_py())
                if not len(g):
                    continue
                parts = held.setdefault(lang, [])
                parts.append((g, n))
                if len(parts) >= 64:
                    held[lang] = [_merge(parts)]
                    if len(held[lang][0][0]) > FLUSH:
                        yield out(lang)
        for lang in list(held):
            yield out(lang)

    taught = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    total = map_texts(taught, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return total.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < ranks).select("lang", "rank", "gram")


class Profiles:
    """Ranks of every profile's n-grams, as one sorted table."""

    def __init__(self, rows: list[tuple[str, int, int]], ranks: int = RANKS):
        self.ranks = ranks
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.unique(np.array([r[2] for r in rows], dtype=np.int64))
        self.table = np.full((len(self.grams) + 1, len(self.langs)), ranks, dtype=np.int64)  # the last row: in no profile
        for lang, rank, gram in rows:
            self.table[np.searchsorted(self.grams, gram), self.langs.index(lang)] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): least out-of-place distance, ties to the first language by code point."""
        g, n = grams(text or "")
        if not len(g) or not self.langs:
            return UNKNOWN, 0.0
        g = top_ranks(g, n, self.ranks)
        at = np.searchsorted(self.grams, g)
        at[at == len(self.grams)] = 0
        rank = self.table[np.where(self.grams[at] == g, at, len(self.grams))]
        own = np.arange(len(g))[:, None]
        away = np.where(rank == self.ranks, self.ranks, np.abs(rank - own)).sum(axis=0)
        best = int(np.argmin(away))
        return self.langs[best], 1.0 - float(away[best]) / (self.ranks * len(g))


def identify(docs: DataFrame, profiles: DataFrame, text_col: str = "text", ranks: int = RANKS) -> DataFrame:
    """All columns of docs with `lang_pred` and `score` (0 to 1: one less the distance over the greatest possible).

    The language whose profile is nearest to the document's own ranking of
    n-grams over its whole text. `und` with score 0 for null texts, texts
    without a letter, and when nothing was learnt. Only the text is read; equal
    texts get equal answers; an empty table stays empty; columns already named
    lang_pred or score are replaced. The profiles, at most `ranks` rows a
    language, go to every task.
    """
    model = Profiles([tuple(r) for r in profiles.select("lang", "rank", "gram").collect()], ranks)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(names.index(text_col))]
            yield extend(batch, names, {"lang_pred": pa.array([f[0] for f in found], pa.string()), "score": pa.array([f[1] for f in found], pa.float64())})

    return map_texts(docs, run, plus(docs.schema, "lang_pred string, score double"))


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))
