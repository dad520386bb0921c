"""Substring dedup by super-k-mers: runs of word windows that share a minimiser travel together to its bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, _power_tables, cut, extend, grouped, map_texts, mix64, plus, shield, steps, windows_hash, words_of

#: Words of a window, and of the sub-windows whose least hash is a window's minimiser.
WINDOW, SEED = 50, 8
#: A minimiser with more different super-k-mers than this has its windows dealt out one by one.
HOT = 2000
_LAST = (1 << 63) - 1


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` consecutive values."""
    size, out = 1, values
    while size * 2 <= width:
        out = np.minimum(out[: len(out) - size], out[size:])
        size *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - size : len(values) - size + 1]) if width > size else out


def super_kmers(words: Words, window: int = WINDOW, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """(text, first word, windows, minimiser, digest) of every run of windows that share a minimiser; the digest is of all words the run spans."""
    n = len(words.starts)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, none, none
    start, h = windows_hash(words, seed)
    every = np.full(n - seed + 1, np.iinfo(np.uint64).max, dtype=np.uint64)
    every[start] = h
    least = _least(every, window - seed + 1)
    at = np.flatnonzero(words.text[: n - window + 1] == words.text[window - 1 :])
    if not len(at):
        return none, none, none, none, none
    least = least[at]
    head = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (least[1:] != least[:-1]))))
    first, count = at[head], np.diff(head, append=len(at))
    p, q = _power_tables(n + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words.hash * p[:n], out=run[1:])
        digest = mix64((run[first + count + window - 1] - run[first]) * q[first] ^ count.astype(np.uint64))
    text = words.text[first]
    return text, first - words.first[text], count, least[head].view(np.int64), digest.view(np.int64)


def _scan(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in steps(batch.column(2)):
                text, first, count, least, digest = super_kmers(Words(data, offsets), window, seed)
                rows = pa.array(text + row)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(first), pa.array(count), pa.array(least), pa.array(digest)], ["_id", "_th", "first", "n", "least", "digest"])

    return run


def _extract(window: int):
    """Packed strings (words joined by one space) of the super-k-mers that each document stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("least", "digest", "n", "low", "packed")}
            for text, wanted in zip(batch.column(0), batch.column(1)):
                words = words_of(text.as_py())
                for w in wanted.as_py():
                    for k in ("least", "digest", "n", "low"):
                        out[k].append(w[k])
                    out["packed"].append(" ".join(words[w["first"] : w["first"] + w["n"] + window - 1]))
                if len(out["packed"]) >= 5000:
                    yield pa.RecordBatch.from_pydict(out)
                    out = {k: [] for k in out}
            if out["packed"]:
                yield pa.RecordBatch.from_pydict(out)

    return run


def _windows(packed: pa.Array, window: int) -> tuple[bytes, Words, np.ndarray, np.ndarray]:
    blob = "\n".join(packed.to_pylist()).encode()
    raw = np.frombuffer(blob, dtype=np.uint8)
    ends = np.append(np.flatnonzero(raw == 10), len(raw))
    words = Words(raw, np.concatenate(([0], ends + 1)).clip(max=len(raw)))
    start, h = windows_hash(words, window)
    return blob, words, start, h


def _lowest(packed: pa.Array, low: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each packed string: the number of its string, and the least id among equal windows. Sorting by hash brings equal windows together; their bytes are compared."""
    blob, words, start, h = _windows(packed, window)
    owner = words.text[start]
    order = np.argsort(h, kind="stable")
    s, e = words.starts[start[order]], words.ends[start[order] + window - 1]
    best = low[owner].copy()
    bounds = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1], [True])))
    for a, b in zip(bounds[:-1][np.diff(bounds) > 1].tolist(), bounds[1:][np.diff(bounds) > 1].tolist()):
        kinds: dict[bytes, list[int]] = {}
        for i in range(a, b):
            kinds.setdefault(blob[s[i] : e[i]], []).append(order[i])
        for same in kinds.values():
            best[same] = best[same].min()
    return owner, best


def _count_bucket(window: int):
    """Rows sorted by minimiser: whole buckets, many at a time; lows of every window of every packed string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["least"], 20_000):
            # rows equal in id and text bring the same string more than once
            once = np.unique(np.stack([group.column(k).to_numpy() for k in ("least", "digest", "n")]), axis=1, return_index=True)[1]
            group = group.take(pa.array(np.sort(once)))
            low = group.column("low").to_numpy()
            # one sort serves many buckets: equal windows have equal minimisers
            owner, best = _lowest(group.column("packed"), low, window)
            n = np.bincount(owner, minlength=group.num_rows)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(best))
            yield pa.RecordBatch.from_arrays([group.column("least"), group.column("digest"), group.column("n"), lists], ["least", "digest", "n", "lows"])

    return run


def _hot_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                group = batch.slice(at, 2000)
                _, words, start, h = _windows(group.column(4), window)
                owner = words.text[start]
                with np.errstate(over="ignore"):
                    other = np.zeros(len(start), dtype=np.uint64)
                    for i in range(window):
                        other = other * np.uint64(0xD6E8FEB86659FD93) + mix64(words.hash[start + i] ^ np.uint64(0xA0761D6478BD642F))
                rows = pa.array(owner)
                place = start - words.first[owner]
                yield pa.RecordBatch.from_arrays([*(group.column(i).take(rows) for i in range(4)), pa.array(place), pa.array(h.view(np.int64)), pa.array(other.view(np.int64))], ["least", "digest", "n", "low", "place", "h1", "h2"])

    return run


def _remove(window: int, names: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_text": []}
            for text, found in zip(batch.column(names.index(text_col)), batch.column(names.index("_found"))):
                words, found = words_of(text.as_py()), found.as_py()
                out["n_words"].append(len(words))
                if found:
                    hit = np.zeros(len(words) + 1, dtype=np.int64)
                    found = np.array(found)
                    np.add.at(hit, found, 1)
                    np.add.at(hit, found + window, -1)
                    keep = np.cumsum(hit[:-1]) == 0
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                out["n_removed"].append(out["n_words"][-1] - len(words))
                out["kept_text"].append(" ".join(words))
            yield extend(batch, names, {"n_words": pa.array(out["n_words"], pa.int64()), "n_removed": pa.array(out["n_removed"], pa.int64()), "kept_text": pa.array(out["kept_text"], pa.string())})

    return run


def _hot_lows(kinds: DataFrame, packed, window: int) -> DataFrame:
    """The least id of every window of the given super-k-mers, window by window."""
    key = ["least", "digest", "n"]
    each = cut(packed(kinds).mapInArrow(_hot_windows(window), "least long, digest long, n long, low long, place long, h1 long, h2 long"), "hot-windows")
    least = each.groupBy("h1", "h2").agg(F.min("low").alias("best"), F.max("low").alias("worst")).where("best < worst").select("h1", "h2", "best")
    lesser = each.join(least, ["h1", "h2"]).where("best < low").groupBy(*key).agg(F.collect_set(F.struct("place", "best")).alias("known"))
    # windows without a lesser id elsewhere have the super-k-mer's own
    known = F.map_from_entries(F.coalesce("known", F.array().cast("array<struct<place:bigint,best:bigint>>")))
    lows = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda j: F.coalesce(F.try_element_at(known, j), F.col("low")))
    return kinds.select(*key, "low").join(lesser, key, "left").select(*key, lows.alias("lows"))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """All columns of docs with n_words, n_removed and kept_text (kept words joined by one space).

    A word goes if a window of `window` words covers it whose word sequence also
    starts in a document with a smaller id. All windows are judged on the input.

    One scan finds every document's super-k-mers as small rows (minimiser, digest,
    place). Rows with equal digests are one super-k-mer, counted before the
    shuffle, so copies weigh nothing. A minimiser seen in one document only
    settles nothing and is dropped; one with a single different super-k-mer is
    settled by its least id; the others' packed strings, one per different
    super-k-mer, travel to the minimiser's bucket, where sorting brings equal
    windows together. A minimiser with over `hot` different super-k-mers, as a
    common passage in many surroundings has, has its windows dealt out by 128-bit
    digests instead and pre-aggregated, so no task holds it whole. Texts are
    shuffled once, by document.

    Null and short texts lose nothing. A null id counts as the greatest. Rows
    equal in id and text are one document: equal ids never remove from each
    other. Columns named like the new ones are replaced, all others stay. An
    empty table stays empty.
    """
    docs, (id_col, text_col), back = shield(docs, id_col, text_col)
    own = docs.withColumns({"_id": F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)), "_th": F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0))})
    light = own.select("_id", "_th", F.col(text_col).cast("string").alias("text"))
    light = map_texts(light, _scan(window, seed), "_id long, _th long, first long, n long, least long, digest long")
    light = cut(light, "super-kmers")
    key = ["least", "digest", "n"]
    shared = light.groupBy("least").agg(F.min("_id").alias("_low"), F.max("_id").alias("_high")).where("_low < _high").select("least")
    light = cut(light.join(shared, "least"), "shared-kmers")
    kinds = light.groupBy(*key).agg(F.min(F.struct("_id", "_th", "first")).alias("one")).withColumn("low", F.col("one._id"))
    buckets = kinds.groupBy("least").agg(F.count("*").alias("kinds"))
    kinds = cut(kinds.join(buckets, "least"), "kinds")

    texts = own.select("_id", "_th", F.col(text_col).cast("string").alias("text"))
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = texts.repartition(spread, "_id", "_th")

    def packed(some: DataFrame) -> DataFrame:
        wanted = some.groupBy(F.col("one._id").alias("_wid"), F.col("one._th").alias("_wth")).agg(F.collect_list(F.struct("least", "digest", "n", "low", F.col("one.first").alias("first"))).alias("wanted"))
        found = texts.join(wanted, (F.col("_id") == F.col("_wid")) & (F.col("_th") == F.col("_wth")))
        return found.select("text", "wanted").mapInArrow(_extract(window), "least long, digest long, n long, low long, packed string")

    alone = kinds.where("kinds = 1").select(*key, F.array_repeat("low", F.col("n").cast("int")).alias("lows"))
    lows_type = "least long, digest long, n long, lows array<long>"
    some = packed(kinds.where((F.col("kinds") > 1) & (F.col("kinds") <= hot))).repartition(spread, "least").sortWithinPartitions("least").mapInArrow(_count_bucket(window), lows_type)
    lows = alone.unionByName(some)
    if not kinds.where(F.col("kinds") > hot).isEmpty():
        lows = lows.unionByName(_hot_lows(kinds.where(F.col("kinds") > hot), packed, window))

    hit = light.join(lows, key).select("_id", "_th", F.filter(F.transform("lows", lambda low, j: F.when(low < F.col("_id"), F.col("first") + j)), lambda x: x.isNotNull()).alias("hit")).where(F.size("hit") > 0)
    found = hit.groupBy(F.col("_id").alias("_fid"), F.col("_th").alias("_fth")).agg(F.flatten(F.collect_list("hit")).alias("_found"))
    # only the columns that a task needs travel when docs has no others
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    if rest:
        every = own.repartition(spread, "_id", "_th")
    else:
        every = texts.select("_id", "_th", F.col("text").alias(text_col))
        every = every.withColumn(id_col, F.when(F.col("_id") < _LAST, F.col("_id")).cast(docs.schema[id_col].dataType))
    joined = every.join(found, (F.col("_id") == F.col("_fid")) & (F.col("_th") == F.col("_fth")), "left").select(*docs.columns, "_found")
    out = map_texts(joined, _remove(window, joined.columns, text_col), plus(joined.schema, "n_words long, n_removed long, kept_text string"))
    return back(out, "n_words", "n_removed", "kept_text")
