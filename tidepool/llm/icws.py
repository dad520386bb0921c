"""Near-dedup by improved consistent weighted sampling of TF-IDF shingles, banded, checked by weighted Jaccard similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, block_pairs, by_text_and_hash, cut, distinct, find, grouped, local_components, map_texts, mix64, shield, steps, windows_hash
from .components import connected_components

#: Words of a shingle, least similarity, bands and samples of a band.
SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 14, 4
#: Words whose document frequencies go to every task, 12 bytes each: all that stand in more than one text, as long as they are no more. Those of rarer words travel with the texts.
TABLE_WORDS = 400_000
#: Words counted before a task passes its counts on.
FLUSH = 2_000_000
#: Texts of a chunk of a large candidate group.
CHUNK = 192


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Summed counts of equal hashes."""
    hashes, which = distinct(np.concatenate([p[0] for p in parts]))
    return hashes, np.bincount(which, weights=np.concatenate([p[1] for p in parts]), minlength=len(hashes)).astype(np.int64)


def _words_by_text(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, number) of each word of a text, once a text, and the hashes that the numbers stand for."""
    hashes, which = distinct(words.hash)
    bits = max(1, len(hashes)).bit_length()
    pairs = np.sort(words.text << bits | which)
    pairs = pairs[np.concatenate(([True], pairs[1:] != pairs[:-1]))[: len(pairs)]]
    return pairs >> bits, pairs & ((1 << bits) - 1), hashes


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, df): in how many of the partition's texts each word, known by its 64-bit hash, stands."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def out():
        hashes, df = _merge(held)
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(df)], ["word", "df"])

    for batch in batches:
        for _, _, data, offsets in steps(batch.column(0)):
            _, which, hashes = _words_by_text(Words(data, offsets))
            if not len(hashes):
                continue
            held.append((hashes, np.bincount(which, minlength=len(hashes))))
            n += len(hashes)
            if n > FLUSH:
                held = [_merge(held)]
                n = len(held[0][0])
                if n > FLUSH // 2:
                    yield out()
                    held, n = [], 0
    if held:
        yield out()


class InverseFrequencies:
    """IDF of words by hash: 1 + ln((1 + N) / (1 + df)) / ln(1 + N), from 1 to 2. Words without an entry count as `floor`.

    With a floor of 1 these are the words of one text. With a higher one, `knowing`
    adds the exact frequencies of the rarer words that some texts brought along.
    """

    def __init__(self, n: int, floor: int, hashes: np.ndarray, df: np.ndarray):
        order = np.argsort(hashes)
        self.n, self.hashes, self.floor = n, hashes[order], floor
        self.values, self.rare = self._idf(df[order].astype(np.float64)), self._idf(np.array([float(floor)]))[0]

    def _idf(self, x: np.ndarray) -> np.ndarray:
        return (1 + np.log((1 + self.n) / (1 + x)) / np.log(1 + max(self.n, 1))).astype(np.float32)

    def knowing(self, more: pa.ListArray) -> _Known:
        """This table with the (word, df) lists of some texts, whose words without an entry stand in one text."""
        flat = more.flatten()
        hashes, first = np.unique(flat.field("word").to_numpy().view(np.uint64), return_index=True)
        return _Known(self, hashes, self._idf(flat.field("df").to_numpy()[first].astype(np.float64)))

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes) or not len(hashes):
            return np.full(len(hashes), self.rare, dtype=np.float32)
        own, which = distinct(hashes)
        at, here = find(self.hashes, own)
        return np.where(here, self.values[at], self.rare).astype(np.float32)[which]


class _Known:
    """A table of frequent words and the exact weights of a few texts' rarer words."""

    def __init__(self, table: InverseFrequencies, hashes: np.ndarray, values: np.ndarray):
        self.table, self.hashes, self.values = table, hashes, values
        self.single = table._idf(np.array([1.0]))[0]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        own, which = distinct(hashes)
        found = np.full(len(own), self.single, dtype=np.float32)
        for table, values in ((self.table.hashes, self.table.values), (self.hashes, self.values)):
            if len(table):
                at, here = find(table, own)
                found = np.where(here, values[at], found)
        return found.astype(np.float32)[which]


def inverse_frequencies(docs: DataFrame, text_col: str = "text", table_words: int = TABLE_WORDS) -> InverseFrequencies:
    """The IDF table of ``word_frequencies``: exact for all words while its floor is 1."""
    return word_frequencies(docs, text_col, table_words)[0]


def word_frequencies(docs: DataFrame, text_col: str = "text", table_words: int = TABLE_WORDS) -> tuple[InverseFrequencies, DataFrame | None]:
    """IDF from the exact document frequencies of all words of all texts, and (word, df) of the words that the table leaves out.

    A word of one text needs no entry. As long as no more than `table_words`
    words stand in two texts or more, the table has them all and nothing is left
    out. Beyond that the floor doubles until the words above it fit, and those of
    2 to `floor` texts are left out: ``rare_words`` brings them to their texts.
    """
    n = docs.count()
    counted = map_texts(docs.select(F.col(text_col).cast("string").alias("text")), _word_counts, "word long, df long").groupBy("word").agg(F.sum("df").alias("df"))
    counted = cut(counted.where("df > 1"), "word-frequencies")
    floors = [1 << j for j in range(48)]
    above = counted.agg(*[F.count(F.when(F.col("df") > f, 1)).alias(f"n{j}") for j, f in enumerate(floors)]).first()
    floor = next(f for j, f in enumerate(floors) if above[f"n{j}"] <= table_words)
    rows = counted.where(F.col("df") > floor).toArrow()
    table = InverseFrequencies(n, floor, rows.column("word").to_numpy().view(np.uint64), rows.column("df").to_numpy())
    return table, counted.where(F.col("df") <= floor) if floor > 1 else None


def _untabled(idf):
    """(h1, h2, word) of each word of a text that the table does not hold, once a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, data, offsets in steps(batch.column(2)):
                text, which, hashes = _words_by_text(Words(data, offsets))
                new = ~find(idf.value.hashes, hashes)[1][which]
                at = pa.array(text[new] + row)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(hashes[which[new]].view(np.int64))], ["h1", "h2", "word"])

    return run


def rare_words(texts: DataFrame, idf, rest: DataFrame) -> DataFrame:
    """(h1, h2, rare): by text the (word, df) list of its words in `rest`. Texts are given as (h1, h2, text), equal ones once or more."""
    pairs = map_texts(texts, _untabled(idf), "h1 long, h2 long, word long").join(rest, "word")
    return pairs.groupBy("h1", "h2").agg(F.collect_set(F.struct("word", "df")).alias("rare"))


def elements(words: Words, idf: InverseFrequencies) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, element, weight) sorted by both: the weighted sets of texts.

    A shingle of SHINGLE words weighs (1 + ln tf) times the mean IDF of its
    words. Its l-th occurrence is an element of its own, with the weight that it
    adds; so an element weighs the same wherever it stands, and the least and
    greatest weights of two texts are sums over common and over all elements. A
    text of fewer words has one shingle of them all.
    """
    start, h = windows_hash(words, SHINGLE)
    own = idf.of(words.hash)
    run = np.concatenate(([0.0], np.cumsum(own, dtype=np.float64)))
    weight = (run[start + SHINGLE] - run[start]) / SHINGLE
    text = words.text[start]
    size = np.diff(words.first)
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    if len(short):
        more = []
        for t in short.tolist():
            a, b = words.first[t], words.first[t + 1]
            key = np.uint64(b - a)
            for w in words.hash[a:b]:
                key = mix64(np.array([key ^ w]))[0]
            more.append((t, key, (run[b] - run[a]) / (b - a)))
        text = np.concatenate((text, [m[0] for m in more])).astype(np.int64)
        h = np.concatenate((h, np.array([m[1] for m in more], dtype=np.uint64)))
        weight = np.concatenate((weight, [m[2] for m in more]))
    order = by_text_and_hash(text, h)
    text, h, weight = text[order], h[order], weight[order]
    if not len(text):
        return text, h, weight
    head = np.concatenate(([True], (text[1:] != text[:-1]) | (h[1:] != h[:-1])))
    at = np.arange(len(text))
    level = at - np.maximum.accumulate(np.where(head, at, 0)) + 1
    again = level > 1
    h[again] = mix64(h[again] ^ level[again].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    weight[again] *= np.log(level[again] / (level[again] - 1))
    return text, h, weight


def _gamma_table() -> np.ndarray:
    """65536 mid-quantiles of Gamma(2, 1)."""
    q = (np.arange(65536) + 0.5) / 65536
    x = np.ones_like(q)
    low, high = np.zeros_like(q), np.full_like(q, 40.0)
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - np.exp(-x) * (1 + x) < q
        low, high = np.where(below, x, low), np.where(below, high, x)
    return x.astype(np.float32)


#: Of a text whose elements weigh S, the least value ln c - r (t - beta + 1) is above ln(SURE / S) with probability exp(-SURE).
SURE = 6.0


class Sampler:
    """BANDS * ROWS consistent weighted samples of a text's elements."""

    def __init__(self) -> None:
        self.r = _gamma_table()
        self.inverse, self.log = (1 / self.r).astype(np.float32), np.log(self.r)
        # ln c - r is at least this for the first 8 bits of r's and of c's numbers; a little less, for rounding
        self.bound = (self.log[::256][None, :] - self.r[255::256][:, None] - np.float32(0.01)).reshape(-1)
        self.seeds = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def __call__(self, text: np.ndarray, element: np.ndarray, weight: np.ndarray, n_text: int) -> np.ndarray:
        """(n_text, BANDS * ROWS) codes of the samples (element, quantised weight); 0 for texts without elements.

        For weight w and Gamma(2, 1) variates r, c and a uniform beta, all drawn
        from the element's hash: t = floor(ln w / r + beta), and the sample is the
        element with the least ln c - r (t - beta + 1), together with its t. As
        r (t - beta) <= ln w, that is at least ln c - r - ln w: elements for which
        this is above their text's limit are not looked at further, and a text whose
        least value is above the limit is looked at whole. No sample is changed.
        """
        out = np.zeros((n_text, len(self.seeds)), dtype=np.uint32)
        if not len(text):
            return out
        head = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
        log_w = np.log(weight).astype(np.float32)
        count = np.diff(head, append=len(text))
        number = np.repeat(np.arange(len(head)), count)
        limit = np.log(SURE / np.add.reduceat(weight.astype(np.float64), head)).astype(np.float32)
        most = log_w + limit[number]
        u, shifted, bins = np.empty_like(element), np.empty_like(element), np.zeros(len(element), dtype=np.int64)
        octet, of_bin = u.view(np.uint8), bins.view(np.uint8)
        bound = np.empty(len(element), dtype=np.float32)
        for k, seed in enumerate(self.seeds):
            with np.errstate(over="ignore"):
                np.bitwise_xor(element, seed, out=u)
                u *= np.uint64(0xFF51AFD7ED558CCD)
                u ^= np.right_shift(u, np.uint64(32), out=shifted)
                u *= np.uint64(0xC4CEB9FE1A85EC53)
            of_bin[1::8], of_bin[::8] = octet[7::8], octet[5::8]
            np.take(self.bound, bins, out=bound, mode="clip")
            some = np.flatnonzero(bound <= most)
            least, first, t = self._least(u[some], log_w[some], number[some], len(head))
            first = some[first] if len(some) else first
            again = np.flatnonzero(least > limit)
            if len(again):
                whole = np.concatenate([np.arange(head[j], head[j] + count[j]) for j in again.tolist()])
                _, f, t[again] = self._least(u[whole], log_w[whole], np.repeat(np.arange(len(again)), count[again]), len(again))
                first[again] = whole[f]
            code = mix64(element[first] ^ mix64(t.astype(np.int64).view(np.uint64)))
            out[text[head], k] = (code >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        return out

    def _least(self, u: np.ndarray, log_w: np.ndarray, number: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The least value of each of n texts, the first place where it stands, and its t. A text without an element has an infinite value and any place."""
        least, place, level = np.full(n, np.inf, dtype=np.float32), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.float32)
        if not len(u):
            return least, place, level
        u = u ^ (u >> np.uint64(29))
        half = u.view(np.uint16).reshape(-1, 4)
        i = half[:, 3]
        beta = u.view(np.uint32)[::2].astype(np.float32)
        beta *= np.float32(2.0**-32)
        t = log_w * self.inverse[i]
        t += beta
        np.floor(t, out=t)
        beta -= t
        beta -= np.float32(1)
        beta *= self.r[i]
        beta += self.log[half[:, 2]]  # now ln c - r (t - beta + 1)
        head = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
        least[number[head]] = np.minimum.reduceat(beta, head)
        first = np.flatnonzero(beta == least[number])
        first = first[np.searchsorted(first, head)]
        place[number[head]], level[number[head]] = first, t[first]
        return least, place, level


def band_keys(codes: np.ndarray) -> np.ndarray:
    """(texts, BANDS) hashes of each band's samples."""
    key = np.zeros((len(codes), BANDS), dtype=np.uint64)
    for r in range(ROWS):
        key = mix64(key ^ codes[:, r::ROWS].astype(np.uint64) ^ np.uint64(r + 1 << 32))
    return mix64(key ^ np.arange(BANDS, dtype=np.uint64)[None, :])


def _signatures(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = Sampler()
        for batch in batches:
            for row, to, data, offsets in steps(batch.column(3), 1 << 18):
                known = idf.value.knowing(batch.column(4).slice(row, to - row)) if batch.num_columns > 4 else idf.value
                codes = sample(*elements(Words(data, offsets), known), to - row)
                some = codes[:, 0] != 0
                keys = band_keys(codes).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(some * BANDS))).astype(np.int32)), pa.array(keys[some].reshape(-1)))
                own = batch.slice(row, to - row)
                yield pa.RecordBatch.from_arrays([*own.columns[:3], pa.array(np.diff(offsets)), lists, pa.array([c.tobytes() for c in codes], pa.binary())], ["doc", "h1", "h2", "bytes", "bands", "codes"])

    return run


def weighted_similarities(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n_text: int) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs of a few texts, in double precision."""
    total = np.bincount(text, weights=weight, minlength=n_text)
    _, which, seen = np.unique(element, return_inverse=True, return_counts=True)
    shared = seen[which] > 1
    text, which, weight = text[shared], which[shared], weight[shared]
    common = np.zeros((n_text, n_text))
    order = np.argsort(which, kind="stable")
    text, which, weight = text[order], which[order], weight[order]
    _, column = np.unique(which, return_inverse=True)
    width = max(1, (4 << 20) // max(1, n_text))
    edges = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + width, width))
    for a, b in zip(edges[:-1], edges[1:]):
        if a < b:
            base = column[a]
            has = np.zeros((n_text, int(column[b - 1] - base) + 1))
            has[text[a:b], column[a:b] - base] = np.sqrt(weight[a:b])
            common += has @ has.T
    union = total[:, None] + total[None, :] - common
    return np.divide(common, union, out=np.zeros_like(common), where=union > 0)


def _verify(idf, similarity: float):
    """Of each block of texts: each with the least one of its block that links of the block reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["group", "_a", "_b"], 256):
            group, a, b, node, chunk = (table.column(k).to_numpy() for k in ("group", "_a", "_b", "node", "_c"))
            codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), dtype=np.uint32).reshape(len(node), -1)
            keys = band_keys(codes)
            edge = np.flatnonzero(np.concatenate(([True], (np.diff(group) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0), [True])))
            nodes: list[np.ndarray] = []
            roots: list[np.ndarray] = []
            for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
                n = j - i
                if n < 2:
                    continue
                likely = np.zeros((n, n), dtype=bool)
                for k in range(BANDS):
                    likely |= keys[i:j, k][:, None] == keys[None, i:j, k]
                if a[i] != b[i]:
                    likely &= chunk[i:j, None] != chunk[None, i:j]
                np.fill_diagonal(likely, False)
                rows = np.flatnonzero(likely.any(axis=1))
                if not len(rows):
                    continue
                parts = list(steps(table.column("text").slice(i, n).take(pa.array(rows)), 1 << 40))
                _, _, data, offsets = parts[0]
                known = idf.value.knowing(table.column("rare").slice(i, n).take(pa.array(rows))) if "rare" in table.schema.names else idf.value
                like = weighted_similarities(*elements(Words(data, offsets), known), len(rows))
                linked = likely[np.ix_(rows, rows)] & (like >= similarity)
                own = node[i:j][rows]
                by = np.argsort(own)
                nodes.append(own[by])
                roots.append(own[by][local_components(linked[np.ix_(by, by)])])
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(roots))], ["node", "root"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, chunk: int = CHUNK, table_words: int = TABLE_WORDS) -> DataFrame:
    """(doc, h1, class_id) of every row: the class of documents that are near copies, named by its least document id.

    Texts are linked if the weighted Jaccard similarity of their TF-IDF shingles
    is at least `similarity`; classes are the connected components. IDF comes from
    exact document frequencies of all words (see `word_frequencies`). Equal texts are one representative each, so copies meet
    nobody. Representatives whose samples agree in a whole band are candidates;
    candidates that hang together form groups, whose texts are fetched once and
    compared in blocks of at most two chunks: every pair that shares a band has
    its similarity computed exactly. No pair is written.

    A pair of similarity s shares a band with probability 1 - (1 - s**4)**14:
    0.9994 at 0.8. Null and wordless texts and rows with a null id link with
    nothing; texts under five words are one shingle; rows with equal ids are one
    document. Rows with equal texts have equal classes. An empty table gives an
    empty result. h1 is xxhash64 of the text, doc the id as a long.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    own = own.select("doc", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")
    table, rest = word_frequencies(own, "text", table_words)
    idf = docs.sparkSession.sparkContext.broadcast(table)
    rare, known = [], lambda df: df
    if rest is not None:
        # the exact way for words that the table has no room for: their frequencies travel with the texts
        lists = cut(rare_words(own.select("h1", "h2", "text"), idf, rest), "rare-words")
        none = F.array().cast(lists.schema["rare"].dataType)
        rare, known = ["rare"], lambda df: df.join(lists, ["h1", "h2"], "left").select(*df.columns, F.coalesce("rare", none).alias("rare"))
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed = cut(map_texts(known(own), _signatures(idf), "doc long, h1 long, h2 long, bytes long, bands array<long>, codes binary"), "signatures")

    able = signed.where("doc is not null and size(bands) > 0")
    texts = cut(able.groupBy("h1", "h2").agg(F.min("doc").alias("node")), "representatives")
    key = ["h1", "h2"]
    reps = able.join(texts, key).where("doc = node").dropDuplicates(["node", *key]).select("node", *key, "bytes", "bands", "codes")

    band = reps.select("node", F.explode("bands").alias("band"))
    least = band.groupBy("band").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1").select("band", "first")
    groups = connected_components(band.join(least, "band"), "node", "first").withColumnRenamed("component", "group")
    members = reps.drop("bands").join(groups, "node")
    # a text counts as one row and one more for every 8 KB
    size = members.groupBy("group").agg((F.count("*") + F.sum(F.floor(F.col("bytes") / 8192))).alias("size"))
    # the lists of a few candidates join them here, so that texts are dealt out once more only
    members = known(members.join(size, "group"))
    full = members.join(own.select(F.col("doc").alias("node"), *key, "text"), ["node", *key]).dropDuplicates(["node", *key])
    blocks = block_pairs(full, ["group"], "size", F.xxhash64("node", "h1"), chunk)
    block = ["group", "_a", "_b"]
    found = blocks.select(*block, "_c", "node", "codes", "text", *rare).repartition(spread, *block).sortWithinPartitions(*block).mapInArrow(_verify(idf, similarity), "node long, root long")
    classes = connected_components(found, "node", "root")

    named = texts.join(classes, "node", "left").select(*key, F.coalesce("component", "node").alias("class_id"))
    out = signed.select("doc", *key).join(named, key, "left")
    return out.select("doc", "h1", F.when(F.col("doc").isNotNull(), F.coalesce("class_id", "doc")).alias("class_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs of which each class of near duplicates keeps one: the one with the least id (ties: the least text hash).

    Rows equal in id and text stay once; rows with a null id all stay.
    """
    docs, (id_col, text_col), back = shield(docs, id_col, text_col)
    classes = near_duplicates(docs, id_col, text_col, **how)
    first = classes.where("doc is not null").groupBy("class_id").agg(F.min(F.struct("doc", "h1")).alias("one")).select("one.doc", "one.h1")
    keyed = docs.withColumns({"_id": F.col(id_col).cast("long"), "_th": F.xxhash64(F.col(text_col))})
    kept = keyed.join(first, (F.col("_id") == F.col("doc")) & (F.col("_th") == F.col("h1"))).dropDuplicates(["_id", "_th"])
    return back(kept.select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull())))
