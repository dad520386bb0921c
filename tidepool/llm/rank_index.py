"""Fill-in-middle: a learned index from token rank to text offset gives every cut.

The offsets of a text's token boundaries are a nearly straight line over their
ranks. The index keeps line segments that are off by a bounded error at any
boundary and the residual of each, so an offset is one prediction and one exact
correction, and boundaries cost a byte each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import extend, map_texts, plus, steps

#: Greatest distance of a boundary from its segment; a residual fits a signed byte.
ERROR = 127
#: Ranks that the search for a segment's end looks at first; then twice as many, and so on.
FIRST_LOOK = 64
MARKS = ("<P>", "<S>", "<M>")
#: Of a hundred texts: those cut, and of these the ones written suffix first.
CUT_SHARE, SPM_SHARE = 50, 80


class RankIndex:
    """Offsets by rank: segments (first rank, offset there, slope) and a signed byte of residual a rank."""

    __slots__ = ("base", "residual", "slope", "start")

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        """Fit non-decreasing offsets: each segment starts at its first point and reaches as far as one slope stays within `error` of all."""
        start, slope, n, at = [], [], len(offsets), 0
        while at < n:
            low, high, to, look = -np.inf, np.inf, at + 1, FIRST_LOOK
            while to < n:
                rise = (offsets[to : to + look] - offsets[at]).astype(np.float64)
                run = np.arange(to - at, to - at + len(rise), dtype=np.float64)
                lows = np.maximum(np.maximum.accumulate((rise - error + 1) / run), low)
                highs = np.minimum(np.minimum.accumulate((rise + error - 1) / run), high)
                fits = int(np.argmax(lows > highs)) if lows[-1] > highs[-1] else len(rise)
                if fits:
                    low, high = lows[fits - 1], highs[fits - 1]
                to += fits
                if fits < len(rise):
                    break
                look *= 2
            start.append(at)
            slope.append((low + high) / 2 if to > at + 1 else 0.0)
            at = to
        self.start = np.array(start, dtype=np.int64)
        self.base = offsets[self.start] if n else np.zeros(0, np.int64)
        self.slope = np.array(slope, dtype=np.float64)
        ranks = np.arange(n)
        residual = offsets - self.predict(ranks)
        if n and np.abs(residual).max() > error:
            raise ValueError("a boundary is farther from its segment than the error bound")
        self.residual = residual.astype(np.int8)

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        """The offsets that the segments alone give."""
        seg = np.searchsorted(self.start, ranks, "right") - 1
        return self.base[seg] + np.rint(self.slope[seg] * (ranks - self.start[seg])).astype(np.int64)

    def offset(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets: prediction and residual."""
        return self.predict(ranks) + self.residual[ranks]


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte offsets of all token boundaries of the texts laid end to end, first boundary of each text; then the total).

    A text's boundaries are its start, the end of each word, and its end if white
    space stands there: tokens are words with the white space before them.
    """
    ink = np.ones(256, dtype=bool)
    ink[list(b" \t\n\x0b\x0c\r")] = False
    black = ink[data]
    stop = np.zeros(len(data) + 1, dtype=bool)
    stop[1:-1] = black[:-1] & ~black[1:]
    filled = offsets[:-1] < offsets[1:]
    # the end of a text that is not empty closes its last token, word or white space
    stop[offsets[1:][filled]] = True
    ends = np.flatnonzero(stop)
    before = np.searchsorted(ends, offsets, "right")
    n = before[1:] - before[:-1]  # ends in (start, end] of each text
    first = np.concatenate(([0], np.cumsum(n + 1)))
    found = np.empty(first[-1], dtype=np.int64)
    at_start = np.zeros(first[-1], dtype=bool)
    at_start[first[:-1]] = True
    found[at_start] = offsets[:-1]
    found[~at_start] = ends
    return found, first


def draws(doc_id: object, seed: int) -> list[int]:
    """Four 32-bit numbers from the SHA-256 of seed and id; a null id counts as an empty one."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(h[k : k + 4], "big") for k in (0, 4, 8, 12)]


def restore(output: str, form: str) -> str:
    """The text that `output` was made of: its parts stand between marks that no cut text contains."""
    if form == "plain":
        return output
    head, _, middle = output.partition("<M>")
    if form == "psm":
        prefix, _, suffix = head.removeprefix("<P>").partition("<S>")
    else:
        suffix, _, prefix = head.removeprefix("<S>").partition("<P>")
    return prefix + middle + suffix


def _round(data: np.ndarray, offsets: np.ndarray, ids: list, seed: int, error: int) -> list[tuple]:
    found, first = boundaries(data, offsets)
    index = RankIndex(found, error)
    n = np.diff(first) - 1
    drawn = np.array([draws(i, seed) for i in ids], dtype=np.int64).reshape(-1, 4)
    u, v = drawn[:, 0] % (n + 1), drawn[:, 1] % (n + 1)
    a, b = (index.offset(first[:-1] + r) - offsets[:-1] for r in (np.minimum(u, v), np.maximum(u, v)))
    raw, out = data.tobytes(), []
    for k in range(len(n)):
        text = raw[offsets[k] : offsets[k + 1]].decode()
        if not text or drawn[k, 2] % 100 >= CUT_SHARE or any(m in text for m in MARKS):
            out.append((int(n[k]), "plain", None, None, text))
            continue
        body = raw[offsets[k] : offsets[k + 1]]
        prefix, middle, suffix = body[: a[k]].decode(), body[a[k] : b[k]].decode(), body[b[k] :].decode()
        if drawn[k, 3] % 100 < SPM_SHARE:
            out.append((int(n[k]), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"))
        else:
            out.append((int(n[k]), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"))
    return out


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, error: int = ERROR) -> DataFrame:
    """All columns of docs with `n` (tokens), `form` (plain, psm or spm), `prefix_chars`, `middle_chars` (null if plain) and `output`.

    Every text is judged whole; a null text is an empty one and stays plain, as
    do texts that hold a mark and those that the draw leaves alone. A null id
    draws like an empty one, repeated rows get equal results, an empty table
    stays empty, and columns already named so are replaced. A task holds an
    Arrow batch of texts and the boundaries of a few megabytes of it, or of one
    longer text.
    """
    names = docs.columns
    id_at, text_at = (names.index(c) for c in (id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, done = batch.column(id_at).to_pylist(), []
            for a, b, data, offsets in steps(batch.column(text_at)):
                done += _round(data, offsets, ids[a:b], seed, error)
            types = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()}
            yield extend(batch, names, {c: pa.array([d[k] for d in done], t) for k, (c, t) in enumerate(types.items())})

    return map_texts(docs, run, plus(docs.schema, "n long, form string, prefix_chars long, middle_chars long, output string"))


def restored(docs: DataFrame) -> DataFrame:
    """All columns of docs with `restored`: the text rebuilt from `output` and `form`. Null where either is null; further columns named so are replaced."""
    names = docs.columns
    output_at, form_at = names.index("output"), names.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(output_at).to_pylist(), batch.column(form_at).to_pylist())
            texts = [None if o is None or f is None else restore(o, f) for o, f in pairs]
            yield extend(batch, names, {"restored": pa.array(texts, pa.string())})

    return map_texts(docs, run, plus(docs.schema, "restored string"))
