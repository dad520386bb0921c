"""Embedding near-dedup with spherical-cap filters: random product codes, list decoding, a join on filters, exact checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_pairs, cut, grouped, local_components
from .components import connected_components

#: Filters that a vector exceeds on average, and the least number of nearest filters it is stored under.
MEAN_FILTERS, LEAST_FILTERS = 24, 16
#: Filters for each (vector, filter) entry: unrelated vectors seldom share one.
SPARSITY = 8
#: Vectors of a chunk of a crowded filter.
CHUNK = 1024
SEED = 20240607
#: Standard deviations by which a cap's edge may part linked vectors.
EDGE = 0.8


def cap_share(dim: int, alpha: float) -> float:
    """Share of the unit sphere whose inner product with a fixed direction is at least alpha."""
    if dim == 1:
        return 0.5
    angle = np.linspace(0, np.pi, 20001)
    density = np.sin(angle) ** (dim - 2)
    return float(np.interp(np.arccos(alpha), angle, np.cumsum(density) / density.sum()))


class ProductCode:
    """Filters c = (c_1, ..., c_m) / sqrt(m), each c_i one of `words` unit vectors of its block of coordinates."""

    def __init__(self, dim: int, n_vectors: int, threshold: float = 0.98, seed: int = SEED):
        self.dim = dim
        self.blocks = np.array_split(np.arange(dim), max(1, min(4, dim // 8)))
        m = len(self.blocks)
        # near vectors must stay near a cap's edge: no cap may be so small that one of two linked vectors
        # on its edge leaves the other outside by more than EDGE standard deviations
        slope = EDGE * np.sqrt((1 - threshold**2) / max(1, dim - 1)) / max(1e-9, 1 - threshold)
        widest = slope / np.sqrt(1 + slope**2)
        wanted = min(SPARSITY * MEAN_FILTERS * max(1, n_vectors), MEAN_FILTERS / cap_share(dim, widest))
        self.words = int(max(2, np.ceil(wanted ** (1 / m))))
        rng = np.random.default_rng([seed, dim])
        self.code = []
        for b in self.blocks:
            c = rng.standard_normal((self.words, len(b)))
            self.code.append(c / np.linalg.norm(c, axis=1, keepdims=True) / np.sqrt(m))
        low, high = -1.0, 1.0
        for _ in range(50):  # the cap that MEAN_FILTERS of all filters' centres fall into
            self.alpha = (low + high) / 2
            low, high = (self.alpha, high) if cap_share(dim, self.alpha) * self.words**m > MEAN_FILTERS else (low, self.alpha)

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the sorted numbers of all filters with inner product of at least alpha, and of its LEAST_FILTERS best.

        The blocks' inner products are summed in two halves. Sorted, they let a
        partial sum be dropped as soon as even the other half's best can't lift
        it to alpha.
        """
        scores = [x[:, b] @ c.T for b, c in zip(self.blocks, self.code)]
        half = len(scores) // 2
        left, right = self._sums(scores[:half], len(x)), self._sums(scores[half:], len(x))
        out = []
        for a, b in zip(left, right):
            alpha = self.alpha
            while True:
                i, j = np.flatnonzero(a >= alpha - b.max()), np.flatnonzero(b >= alpha - a.max())
                total = a[i][:, None] + b[j][None, :]
                p, q = np.nonzero(total >= alpha)
                if len(p) >= min(LEAST_FILTERS, a.size * b.size):
                    break
                alpha -= 0.05
            ids = i[p].astype(np.int64) * len(b) + j[q]
            if alpha < self.alpha:  # too few exceed alpha: the best, and all that exceed it are among them
                best = np.lexsort((ids, -total[p, q]))[:LEAST_FILTERS]
                ids = ids[best]
            out.append(np.sort(ids))
        return out

    @staticmethod
    def _sums(scores: list[np.ndarray], n: int) -> np.ndarray:
        total = np.zeros((n, 1))
        for s in scores:
            total = (total[:, :, None] + s[:, None, :]).reshape(n, -1)
        return total


def _codes(n_vectors: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, ProductCode] = {}
        for batch in batches:
            ids, dims = batch.column(0), batch.column(1).value_lengths().to_numpy()
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                code = codes.get(dim) or codes.setdefault(dim, ProductCode(dim, n_vectors, threshold))
                x = batch.column(1).take(pa.array(rows)).flatten().to_numpy().reshape(-1, dim)
                for at in range(0, len(rows), 256):
                    filters = code.decode(x[at : at + 256])
                    offsets = np.concatenate(([0], np.cumsum([len(f) for f in filters]))).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(filters)))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[at : at + 256])), lists], ["rep", "filters"])

    return run


def _verify(threshold: float):
    """Links within each block of a filter: of each vector the weight of those it links with here and in no lesser common filter, and the least one reachable."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["group", "_a", "_b"], 2000):
            group, a, b = (table.column(k).to_numpy() for k in ("group", "_a", "_b"))
            edge = np.flatnonzero(np.concatenate(([True], (np.diff(group) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0), [True])))
            ids, weight, chunk, at = (table.column(k).to_numpy() for k in ("rep", "weight", "_c", "filter"))
            vectors, filters = table.column("unit"), table.column("filters")
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if j - i < 2:
                    continue
                x = vectors.slice(i, j - i).flatten().to_numpy().reshape(j - i, -1)
                linked = x @ x.T >= threshold
                np.fill_diagonal(linked, False)
                if a[i] != b[i]:
                    linked &= chunk[i:j, None] != chunk[None, i:j]
                rows = np.flatnonzero(linked.any(axis=1))
                if not len(rows):
                    continue
                linked = linked[np.ix_(rows, rows)]
                # a pair counts at its least common filter only
                lists = filters.slice(i, j - i).take(pa.array(rows))
                flat, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy())
                less = flat < at[i]
                kinds, which = np.unique(flat[less], return_inverse=True)
                has = np.zeros((len(rows), len(kinds)), dtype=np.float32)
                has[owner[less], which] = 1
                counted = linked & (has @ has.T == 0)
                own = ids[i:j][rows]
                by_id = np.argsort(own)
                root = own[by_id][local_components(linked[np.ix_(by_id, by_id)])]
                out.append((own, counted @ weight[i:j][rows], root[np.argsort(by_id)]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out])) for k in range(3)], ["rep", "n", "root"])

    return run


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", threshold: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: vectors with equal labels and cosine of at least threshold are linked.

    Equal vectors of a label are one representative with a weight, so copies meet
    nobody. Each representative is stored under every filter of a random product
    code that it exceeds, and under its LEAST_FILTERS best. Filters with one
    vector are dropped while rows still are small; the others bring their vectors
    together in blocks of at most two chunks, where cosines are taken in double
    precision. A link counts at the pair's least common filter, so no pair is
    written and none counts twice; components come from each block's own.

    A pair is missed only if it shares no filter: near vectors share most, and
    recall against brute force is tested. Vectors that are null, have no
    coordinate, hold null or non-finite numbers or only zeros, and rows with a
    null label or id link with nothing. Repeated rows count as other vectors.
    Vectors of unlike length never link. An empty table gives an empty result;
    columns beside the three are not read.
    """
    label = F.col(label_col) if label_col else F.lit(0)
    raw = vectors.select(F.col(id_col).alias("vec_id"), label.cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    fine = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    raw = raw.withColumn("norm", F.when(F.coalesce(fine, F.lit(False)), norm)).withColumn("ok", F.coalesce((F.col("norm") > 0) & (F.col("norm") < float("inf")), F.lit(False)))
    raw = raw.withColumns({"h1": F.when(F.col("ok"), F.xxhash64("label", "v")), "h2": F.when(F.col("ok"), F.xxhash64(F.lit(1), "label", "v"))})
    reps = raw.where("ok").groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.min_by(F.struct("label", F.transform("v", lambda x: x / F.col("norm")).alias("unit")), "vec_id").alias("o"))
    reps = cut(reps.select("h1", "h2", "rep", "weight", "o.label", "o.unit"), "vectors")

    n_vectors = reps.count()
    codes = cut(reps.select("rep", "unit").mapInArrow(_codes(n_vectors, threshold), "rep long, filters array<long>").join(reps.select("rep", F.xxhash64("label", F.size("unit")).alias("group")), "rep"), "filters")
    entry = codes.select("rep", F.explode("filters").alias("filter"), "group")
    crowd = entry.groupBy("group", "filter").agg(F.count("*").alias("size")).where("size > 1")
    entry = entry.join(crowd, ["group", "filter"]).withColumn("group", F.xxhash64("group", "filter"))
    entry = block_pairs(entry, ["group"], "size", F.xxhash64("rep"), CHUNK)
    full = entry.join(reps.select("rep", "weight", "unit"), "rep").join(codes.select("rep", "filters"), "rep")
    spread = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = ["group", "_a", "_b"]
    found = full.repartition(spread, *block).sortWithinPartitions(*block).select(*block, "_c", "rep", "weight", "filter", "unit", "filters").mapInArrow(_verify(threshold), "rep long, n long, root long")
    found = cut(found, "vector-links")

    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    parts = connected_components(found.select("rep", "root"), "rep", "root")
    per_rep = reps.select("h1", "h2", "rep", "weight").join(links, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    per_rep = per_rep.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = raw.select("vec_id", "h1", "h2").join(per_rep, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
