"""Quality rules by compression bands: zstandard ratios of whole documents and of fixed chunks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, extend, map_texts, mix64, plus, steps, windows_hash

LEVEL = 3
CHUNK_BYTES = 4096
#: (bytes below which the band holds, least ratio, greatest ratio): short texts carry the frame's
#: overhead and little history, so both limits fall with length.
BANDS = ((100, 0.60, 1.60), (200, 0.45, 1.25), (800, 0.33, 1.00), (3200, 0.27, 0.80), (20000, 0.22, 0.70), (float("inf"), 0.18, 0.65))
#: Limits of a full chunk; a document goes if more than this share of its chunks lies outside.
CHUNK_BAND, CHUNK_SHARE = (0.22, 0.70), 0.25
#: A remainder of fewer bytes is judged as the end of the chunk before it: the frame's own bytes alone
#: would put the shortest beyond any band.
LEAST_TAIL = 100
#: Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"

FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, n_chunks long, n_bad_chunks long, kept boolean"


def _covered(words: Words, size: int) -> np.ndarray:
    """Which words lie in a window of `size` words found twice or more in their own text."""
    n = len(words.starts)
    start, key = windows_hash(words, size)
    hit = np.zeros(n + 1, dtype=np.int64)
    if len(start):
        key = key ^ mix64(words.text[start].astype(np.uint64) + np.uint64(1))  # equal only within one text
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(hit, start[twice], 1)
        np.add.at(hit, start[twice] + size, -1)
    return np.cumsum(hit[:n]) > 0


def _dup_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in raw:
        return 0
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def band_of(size: int) -> tuple[float, float]:
    return next((low, high) for below, low, high in BANDS if size < below)


def _chunks(size: int) -> list[tuple[int, int]]:
    """Start and end of each chunk of a text: every byte lies in one."""
    edges = [*range(0, size, CHUNK_BYTES), size]
    if len(edges) > 2 and edges[-1] - edges[-2] < LEAST_TAIL:
        del edges[-2]
    return list(zip(edges, edges[1:]))


def _ratios(raw: bytes, z) -> tuple[float, int, int, bool]:
    """(whole ratio, chunks, chunks outside their limits, verdict). The remainder is held to the band of its own length."""
    ratio = len(z.compress(raw)) / len(raw)
    low, high = band_of(len(raw))
    chunks = _chunks(len(raw))
    bad = 0
    for start, end in chunks:
        least, most = CHUNK_BAND if end - start >= CHUNK_BYTES else band_of(end - start)
        own = ratio if end - start == len(raw) else len(z.compress(raw[start:end])) / (end - start)
        bad += not least <= own <= most
    return ratio, len(chunks), bad, low <= ratio <= high and bad <= CHUNK_SHARE * len(chunks)


def _measure(text: pa.Array) -> dict[str, list]:
    import zstandard

    z = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)
    out: dict[str, list] = {c.split()[0]: [] for c in FIELDS.split(", ")}
    symbols = np.zeros(256, dtype=np.int64)
    symbols[list(SYMBOLS)] = 1
    for _, _, data, offsets in steps(text):
        words = Words(data, offsets)
        rows = len(offsets) - 1

        def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
            run = np.concatenate(([0], np.cumsum(values)))
            return run[bounds[1:]] - run[bounds[:-1]]

        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # code points before each byte
        n_words = np.diff(words.first)
        repeat = per_text(_covered(words, WINDOW), words.first)
        base_failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)
        out["n_words"] += n_words.tolist()
        out["word_chars"] += per_text(chars[words.ends] - chars[words.starts], words.first).tolist()
        out["n_symbols"] += per_text(symbols[data], offsets).tolist()
        out["n_repeat_words"] += repeat.tolist()
        out["base_failed"] += base_failed.tolist()
        blob = data.tobytes()
        for i in range(rows):
            raw = blob[offsets[i] : offsets[i + 1]]
            out["n_dup_lines"].append(_dup_lines(raw))
            ratio, chunks, bad, good = _ratios(raw, z) if raw else (None, 0, 0, False)
            out["ratio"].append(ratio)
            out["n_chunks"].append(chunks)
            out["n_bad_chunks"].append(bad)
            out["kept"].append(bool(good and not base_failed[i]))
    return out


def quality_rules(docs: DataFrame, text_col: str = "text", out_col: str = "quality") -> DataFrame:
    """All columns of docs and a struct `quality` of FIELDS: base counts, ratios and the verdict `kept`.

    A document goes if it fails a base rule, if its whole ratio (compressed bytes
    over UTF-8 bytes) lies outside the band of its length, or if more than
    CHUNK_SHARE of its chunks are bad: those of CHUNK_BYTES outside CHUNK_BAND,
    the remainder, or a text shorter than a chunk, outside the band of its own
    length. A remainder under LEAST_TAIL bytes lengthens the chunk before it.
    Each row is judged by itself in one pass without a shuffle; texts of any length are
    compressed whole.

    Null and empty texts count 0 words and go; equal rows get equal verdicts; an
    empty table stays empty; a column already named `quality` is replaced, all
    other columns pass through as they are.
    """
    names = docs.columns
    fields = [c.split() for c in FIELDS.split(", ")]
    types = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}

    def run(batches):
        for batch in batches:
            found = _measure(batch.column(names.index(text_col)))
            struct = pa.StructArray.from_arrays([pa.array(found[n], types[t]) for n, t in fields], [n for n, _ in fields])
            yield extend(batch, names, {out_col: struct})

    return map_texts(docs, run, plus(docs.schema, f"{out_col} struct<{', '.join(f'{n}: {t}' for n, t in fields)}>"))


def reject_low_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that quality_rules keeps, with their own columns."""
    mark = "_verdict"
    while mark in docs.columns:
        mark += "_"
    return quality_rules(docs, text_col, mark).where(F.col(f"{mark}.kept")).drop(mark)
