"""Helpers shared by the operators: words, row keys and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word: a run of characters that are not ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)

_P = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes of text that one vectorised step works on.
STEP_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir, set here only where it is unset (tests)."""
    path = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset: it must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def cut(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet below the shared folder and read it back: lineage ends at files that survive lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shield(docs: DataFrame, *cols: str) -> tuple[DataFrame, list[str], Callable[..., DataFrame]]:
    """docs with columns renamed by position, so that no helper's name clashes with one; the new names of `cols`; and what gives the old names back.

    The last takes a frame with the renamed columns and further ones: those named
    in `new` stay, and replace columns of docs of the same name; others go.
    """
    names = [f"_col{i}" for i in range(len(docs.columns))]
    old = {n.lower(): c for n, c in zip(docs.columns, names)}

    def back(df: DataFrame, *new: str) -> DataFrame:
        lost = {n.lower() for n in new}
        return df.select(*[F.col(c).alias(n) for c, n in zip(names, docs.columns) if c in df.columns and n.lower() not in lost], *new)

    return docs.toDF(*names), [old[c.lower()] for c in cols], back


def words_of(text: str | None) -> list[str]:
    """The words of a text, unchanged; none for null."""
    if not text:
        return []
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    return WORD.findall(text)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) < n:
        n = max(n, STEP_BYTES + 2)
        inverse = pow(_P, -1, 1 << 64)
        for name, base in (("p", _P), ("q", inverse)):
            t = np.full(n, base, dtype=np.uint64)
            t[0] = 1
            np.multiply.accumulate(t, out=t)
            _powers[name] = t
    return _powers["p"], _powers["q"]


#: Rows of an Arrow batch of whole texts: bounds what a task buffers on either side of Python.
TEXT_ROWS = 1000


def map_texts(docs: DataFrame, run, schema) -> DataFrame:
    """mapInArrow over rows that hold whole texts, with at most TEXT_ROWS rows a batch in this session from now on."""
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= TEXT_ROWS:
        conf.set(key, TEXT_ROWS)
    return docs.mapInArrow(run, schema)


#: The bytes between words.
BLANKS = b" \t\n\x0b\x0c\r"


class Words:
    """Words of several UTF-8 texts laid end to end: byte starts and ends, text number, 64-bit hash."""

    __slots__ = ("ends", "first", "hash", "starts", "text")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, blanks: bytes = BLANKS):
        n_text = len(offsets) - 1
        if blanks == BLANKS:
            # 9 to 13 and 32; uint8 wraps around
            black = (data - np.uint8(9) > 4) & (data != 32)
        else:
            ink = np.ones(256, dtype=bool)
            ink[list(blanks)] = False
            black = ink[data]
        begin = black.copy()
        begin[1:] &= ~black[:-1]
        edges = offsets[:-1][offsets[:-1] < offsets[1:]]
        begin[edges] = black[edges]
        finish = np.empty_like(black)
        finish[:-1] = black[:-1] & (~black[1:])
        if len(finish):
            finish[-1] = black[-1]
        last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        finish[last] = black[last]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.starts, offsets)  # first word of each text; then the total
        self.text = np.repeat(np.arange(n_text), np.diff(self.first))
        p, q = _power_tables(len(data) + 1)
        with np.errstate(over="ignore"):
            total = np.empty(len(data) + 1, dtype=np.uint64)
            total[0], sums = 0, total[1:]
            np.add(data, np.uint64(1), out=sums)
            sums *= p[: len(data)]
            np.cumsum(sums, out=sums)
            self.hash = mix64((total[self.ends] - total[self.starts]) * q[self.starts] ^ (self.ends - self.starts).astype(np.uint64))


def steps(column: pa.Array, step_bytes: int = STEP_BYTES):
    """(first row, last row, bytes, offsets) of consecutive rows of a string column, step_bytes each or one longer row. Null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64, count=len(column) + column.offset + 1)[column.offset :] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + step_bytes, "right")) - 1)
        yield row, to, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to


def windows_hash(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start words and 64-bit hashes of all windows of `size` consecutive words within one text."""
    n = len(words.starts)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start = np.flatnonzero(words.text[: n - size + 1] == words.text[size - 1 :])
    with np.errstate(over="ignore"):
        h = np.zeros(n - size + 1, dtype=np.uint64)
        for i in range(size):
            h = h * np.uint64(0x9FB21C651E98DF25) + words.hash[i : n - size + 1 + i]
    return start, mix64(h[start])


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes in the order of their first places, and the number of each one."""
    found = pa.array(hashes).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy()


def find(table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes in a sorted table, and whether they stand there. An empty table has none."""
    if not len(table):
        return np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=bool)
    # sorted hashes walk the table once and stay in the cache
    order = np.argsort(hashes)
    at = np.empty(len(hashes), dtype=np.int64)
    at[order] = np.minimum(np.searchsorted(table, hashes[order]), len(table) - 1)
    return at, table[at] == hashes


def by_text_and_hash(text: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The order of rows by text and hash, equal ones as they stand."""
    bits = int(text.max() if len(text) else 0).bit_length()
    order = np.argsort(text.astype(np.uint64) << np.uint64(64 - bits) | hashes >> np.uint64(bits), kind="stable") if bits else np.argsort(hashes, kind="stable")
    t, h = text[order], hashes[order]
    # the last bits of the hashes are not in the key: where they matter, all is sorted by both
    if bits and np.any((t[1:] == t[:-1]) & (h[1:] < h[:-1])):
        return np.lexsort((hashes, text))
    return order


def plus(schema: T.StructType, fields: str) -> T.StructType:
    """The schema with more fields (DDL), which replace those of the same name."""
    more = T.StructType.fromDDL(fields)
    return T.StructType([f for f in schema.fields if f.name.lower() not in {m.name.lower() for m in more}] + more.fields)


def extend(batch: pa.RecordBatch, names: list[str], more: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with more columns, which replace those of the same name."""
    kept = [(n, c) for n, c in zip(names, batch.columns) if n.lower() not in {m.lower() for m in more}]
    return pa.RecordBatch.from_arrays([c for _, c in kept] + list(more.values()), [n for n, _ in kept] + list(more))


def grouped(batches, keys: list[str], rows: int = 1):
    """Whole groups of rows that are sorted by keys, as record batches of at least `rows` rows where the input has them."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.RecordBatch.from_arrays(batch.columns, batch.schema.names)
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = {k: table.column(k)[n - 1].as_py() for k in keys}
        same = np.ones(n, dtype=bool)
        for k in keys:
            same &= table.column(k).to_numpy() == last[k]
        change = np.flatnonzero(~same)
        done = int(change[-1]) + 1 if len(change) else 0
        if done:
            yield table.slice(0, done).combine_chunks().to_batches()[0]
        rest = table.slice(done).combine_chunks()
        held, n = rest.to_batches(), n - done
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def block_pairs(df: DataFrame, keys: list[str], size: str, salt: Column, rows: int) -> DataFrame:
    """df's rows dealt to blocks of two chunks of their group: columns `_a` <= `_b` name the block's chunks, `_c` the row's own.

    A group of `size` rows (a column) has ceil(size / rows) chunks, filled by the
    hash `salt`; a row goes to every block that its chunk is part of. A group of
    one chunk is one block. No block holds more than about 2 * rows rows.
    """
    chunks = F.ceil(F.col(size) / rows).cast("int")
    own = df.withColumn("_c", F.pmod(salt, chunks).cast("int"))
    return own.withColumn("_o", F.explode(F.sequence(F.lit(0), chunks - 1))).withColumns({"_a": F.least("_c", "_o"), "_b": F.greatest("_c", "_o")}).drop("_o")


def local_components(linked: np.ndarray) -> np.ndarray:
    """The least row number reachable from each row of a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        low = np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(label, low)
        new = np.minimum(new, new[new])
        if np.array_equal(new, label):
            return label
        label = new
