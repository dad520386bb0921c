"""Line dedup by a segment-partition edit join with banded bit-parallel verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import block_pairs, cut, extend, grouped, map_texts, plus, shield

#: Edits up to which lines are near copies, and the code points a line must have for that.
THRESHOLD, MIN_CHARS = 2, 20
#: Lines of a chunk of a crowded segment.
CHUNK = 512
_LAST = (1 << 63) - 1


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance in code points, or most + 1 if it is greater.

    Bit k of word e says: with e edits, the text read so far can be matched up to
    the pattern's position that lies k - most beyond it. Only the 2 * most + 1
    diagonals of the band have bits, so a character costs a few word operations
    for each e; it ends when no word has a bit left.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    low = 0
    high = min(len(a), len(b))
    while low < high:  # common prefix, by halving
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[-mid:] == b[-mid:]:
            low = mid
        else:
            high = mid - 1
    if low:
        a, b = a[:-low], b[:-low]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    n, m = len(a), len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(b):
        where[c] = where.get(c, 0) | 1 << (i + most)
    band = (1 << (2 * most + 1)) - 1

    def inside(read: int) -> int:
        """Diagonals whose pattern position lies in 0..m after `read` characters."""
        first, last = max(0, most - read), min(2 * most, m - read + most)
        return band & ((1 << (last + 1)) - 1) & ~((1 << first) - 1) if last >= first else 0

    state = []
    reach = 1 << most
    for _ in range(most + 1):
        state.append(reach & inside(0))
        reach |= reach << 1
    for j, c in enumerate(a):
        equal, valid = where.get(c, 0) >> j & band, inside(j + 1)
        before = new = 0
        for e, now in enumerate(state):
            new = (now & equal | before | before >> 1 | (new << 1 if e else 0)) & valid
            before, state[e] = now, new
        if not any(state):
            return most + 1
    final = 1 << (m - n + most)
    return next((e for e, now in enumerate(state) if now & final), most + 1)


def _segments(size: int, parts: int) -> list[tuple[int, int]]:
    """Starts and lengths of `parts` segments of a line of `size`; the last ones are longer by one where it doesn't divide."""
    short, longer = size // parts, size % parts
    lengths = [short + (i >= parts - longer) for i in range(parts)]
    return [(sum(lengths[:i]), lengths[i]) for i in range(parts)]


def segment_keys(line: str, most: int) -> tuple[list[int], list[int]]:
    """(keys it is indexed by, further keys it probes).

    A key is a hash of (line length, segment number, segment). A line within
    `most` edits of a longer or equal one has, of its most + 1 segments, one that
    the other holds as a substring. Its start there is bounded by the edits left
    on either side of it, which leaves few substrings to probe for each length.
    """
    parts, n = most + 1, len(line)
    index = [xxhash.xxh3_64_intdigest(f"{n} {i} {line[s : s + k]}".encode("utf-8", "surrogatepass")) for i, (s, k) in enumerate(_segments(n, parts))]
    probe = []
    for size in range(max(parts, n - most), n + 1):
        more = n - size
        for i, (s, k) in enumerate(_segments(size, parts)):
            low = max(0, s - i, s + more - (most - i))
            high = min(n - k, s + i, s + more + (most - i))
            for at in range(low, high + 1):
                if more or at != s:  # its own segments serve as probes for its own length
                    probe.append(xxhash.xxh3_64_intdigest(f"{size} {i} {line[at : at + k]}".encode("utf-8", "surrogatepass")))
    return index, probe


def line_hash(line: str) -> tuple[int, int]:
    """128 bits that stand for a line."""
    h = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return h & 0xFFFFFFFFFFFFFFFF, h >> 64


def _signed(keys: list[int]) -> np.ndarray:
    return np.array(keys, dtype=np.uint64).view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _judged(line: str, min_chars: int, short: bool) -> bool:
    """Whether a line is compared at all: long enough, or with a word if short ones are too."""
    return len(line) >= min_chars or (short and bool(line.strip(" \t\x0b\x0c\r")))


def _occurrences(min_chars: int, short: bool):
    """(_id, _th, no, line, check) of every line that is judged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows: list[int] = []
            numbers: list[int] = []
            hashes: list[tuple[int, int]] = []
            for row, text in enumerate(batch.column(2).to_pylist()):
                for no, line in enumerate((text or "").split("\n")):
                    if _judged(line, min_chars, short):
                        rows.append(row)
                        numbers.append(no)
                        hashes.append(line_hash(line))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(numbers, pa.int64()), *(pa.array(_signed([h[k] for h in hashes])) for k in (0, 1))], ["_id", "_th", "no", "line", "check"])

    return run


def _entries(most: int, min_chars: int):
    """(key, line, indexed, settled) of the different lines of each batch.

    A key with several lines in the batch is settled: they are known to meet, and
    only its first and last line go on to be counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            seen: set[tuple[int, int]] = set()
            keys: list[int] = []
            lines: list[int] = []
            indexed: list[bool] = []
            for text in batch.column(0).to_pylist():
                for line in (text or "").split("\n"):
                    if len(line) < min_chars or (h := line_hash(line)) in seen:
                        continue
                    seen.add(h)
                    index, probe = segment_keys(line, most)
                    keys += index + probe
                    lines += [h[0]] * (len(index) + len(probe))
                    indexed += [True] * len(index) + [False] * len(probe)
            if not keys:
                continue
            key, line, index = _signed(keys), _signed(lines), np.array(indexed)
            order = np.lexsort((line, key))
            key, line, index = key[order], line[order], index[order]
            head = np.concatenate(([True], key[1:] != key[:-1]))
            tail = np.concatenate((head[1:], [True]))
            several = (line[head] != line[tail])[np.cumsum(head) - 1]
            counted = ~several | head | tail
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((x[several], x[counted]))) for x in (key, line, index)] + [pa.array(np.arange(several.sum() + counted.sum()) < several.sum())],
                ["key", "line", "indexed", "settled"],
            )

    return run


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted lines of each text, with their place."""
    for batch in _slices(batches):
        out: dict[str, list] = {k: [] for k in ("line", "check", "_id", "_th", "no", "words")}
        for i, th, text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
            lines = (text or "").split("\n")
            for w in wanted:
                for k, v in (("line", w["line"]), ("check", w["check"]), ("_id", i), ("_th", th), ("no", w["no"]), ("words", lines[w["no"]])):
                    out[k].append(v)
        if out["line"]:
            yield pa.RecordBatch.from_pydict(out)


def _verify(most: int):
    """(line, check) of every line with an earlier one within `most` edits in its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["key", "_a", "_b"], 2000):
            rows = list(zip(*(table.column(k).to_pylist() for k in ("key", "_a", "_b", "_id", "_th", "no", "_c", "indexed", "line", "check", "words"))))
            near: set[tuple[int, int]] = set()
            at = 0
            while at < len(rows):
                to = at
                while to < len(rows) and rows[to][:3] == rows[at][:3]:
                    to += 1
                block = sorted(rows[at:to], key=lambda r: r[3:6])
                across = rows[at][1] != rows[at][2]
                for i, r in enumerate(block):
                    if r[8:10] in near:
                        continue
                    for q in block[:i]:
                        if (r[7] or q[7]) and (not across or r[6] != q[6]) and r[8:10] != q[8:10] and edit_distance(r[10], q[10], most) <= most:
                            near.add(r[8:10])
                            break
                at = to
            yield pa.RecordBatch.from_pydict({"line": pa.array([n[0] for n in near], pa.int64()), "check": pa.array([n[1] for n in near], pa.int64())})

    return run


def _rewrite(names: list[str], text_col: str, min_chars: int, short: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_lines": [], "n_removed": [], "n_near": [], "kept_text": []}
            for text, firsts in zip(batch.column(names.index(text_col)).to_pylist(), batch.column(names.index("_firsts")).to_pylist()):
                lines = [] if text is None else text.split("\n")
                stays = {f["no"] for f in firsts or () if f["stays"]}
                kept = [line for no, line in enumerate(lines) if no in stays or not _judged(line, min_chars, short)]
                out["n_lines"].append(len(lines))
                out["n_removed"].append(len(lines) - len(kept))
                out["n_near"].append(len({f["no"] for f in firsts or ()}) - len(stays))
                out["kept_text"].append(None if text is None else "\n".join(kept))
            yield extend(batch, names, {k: pa.array(v, pa.string() if k == "kept_text" else pa.int64()) for k, v in out.items()})

    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, short: bool = False) -> DataFrame:
    """All columns of docs with n_lines, n_removed, n_near (removed though no equal line comes before) and kept_text.

    A line (between \\n) of at least `min_chars` code points goes if an earlier
    line, in order of document id and line, equals it or is within `threshold`
    edits of it. All lines are judged on the input, also against lines that go
    themselves. With `short`, a shorter line with a word goes if it equals an
    earlier one; otherwise shorter lines always stay.

    Lines are counted as 128-bit hashes; copies merge before the shuffle. Each
    different line is split into threshold + 1 segments and probes the segments
    of lines of its own and lesser lengths as small rows (key, hash). Only lines
    that meet another under a key have their text fetched, once; each key's lines
    are compared in blocks of at most two chunks, so a template that a great part
    of all lines share is never one task's, and no pair is written.

    Null texts stay null with 0 lines; an empty text is one empty line; texts are
    of any length. A null id counts as the greatest; ties in id go by a hash of
    the text, and rows equal in both are one document that keeps the same lines.
    Columns named like the new ones are replaced. An empty table stays empty.
    """
    docs, (id_col, text_col), back = shield(docs, id_col, text_col)
    own = docs.withColumns({"_id": F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)), "_th": F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0))})
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = own.select("_id", "_th", F.col(text_col).cast("string").alias("text"))

    found = cut(map_texts(texts, _occurrences(min_chars, short), "_id long, _th long, no long, line long, check long"), "lines")
    firsts = found.groupBy("line", "check").agg(F.min(F.struct("_id", "_th", "no")).alias("at"))
    entries = map_texts(texts.select("text"), _entries(threshold, min_chars), "key long, line long, indexed boolean, settled boolean")
    # settled rows need no company: they are spread by line, the others meet by key
    by = Window.partitionBy(F.when(F.col("settled"), F.col("line")).otherwise(F.col("key")), "settled")
    entries = entries.withColumns({"low": F.min("line").over(by), "high": F.max("line").over(by)}).where("settled or low < high")
    met = cut(entries.select("key", "line", "indexed"), "line-keys").groupBy("key", "line").agg(F.max("indexed").alias("indexed"))
    crowd = met.groupBy("key").agg(F.count("*").alias("size"), F.max("indexed").alias("any")).where("size > 1 and any").select("key", "size")
    met = cut(met.join(crowd, "key"), "line-groups")

    wanted = firsts.join(met.select("line").distinct(), "line").groupBy(F.col("at._id").alias("_wid"), F.col("at._th").alias("_wth")).agg(F.collect_list(F.struct("line", "check", F.col("at.no").alias("no"))).alias("wanted"))
    dealt = texts.repartition(spread, "_id", "_th")
    lines = dealt.join(wanted, (F.col("_id") == F.col("_wid")) & (F.col("_th") == F.col("_wth"))).select("_id", "_th", "text", "wanted").mapInArrow(_extract, "line long, check long, _id long, _th long, no long, words string")
    blocks = block_pairs(met.join(lines, "line"), ["key"], "size", F.xxhash64("line", "check"), CHUNK)
    block = ["key", "_a", "_b"]
    near = blocks.repartition(spread, *block).sortWithinPartitions(*block).mapInArrow(_verify(threshold), "line long, check long").distinct().withColumn("near", F.lit(True))

    per_doc = firsts.join(near, ["line", "check"], "left").groupBy(F.col("at._id").alias("_fid"), F.col("at._th").alias("_fth")).agg(F.collect_list(F.struct(F.col("at.no").alias("no"), F.col("near").isNull().alias("stays"))).alias("_firsts"))
    if [c for c in docs.columns if c not in (id_col, text_col)]:
        every = own.repartition(spread, "_id", "_th")
    else:  # the same rows as for the lines: dealt once
        every = dealt.withColumns({text_col: F.col("text"), id_col: F.when(F.col("_id") < _LAST, F.col("_id")).cast(docs.schema[id_col].dataType)})
    joined = every.join(per_doc, (F.col("_id") == F.col("_fid")) & (F.col("_th") == F.col("_fth")), "left").select(*docs.columns, "_firsts")
    out = map_texts(joined, _rewrite(joined.columns, text_col, min_chars, short), plus(joined.schema, "n_lines long, n_removed long, n_near long, kept_text string"))
    return back(out, "n_lines", "n_removed", "n_near", "kept_text")
