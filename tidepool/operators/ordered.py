"""Ordered operators (groups F and G) without single-partition windows.

Exact ranks inside a group are computed in two passes so no task ever holds
a whole group: (1) count rows per (group, hash bucket) -- a table of at most
groups x 65,536 rows, aggregated map-side -- and turn the counts into bucket
offsets with a window over that small table; (2) rank rows inside their (group,
bucket) and add the offset, which is the one shuffle of the rows. Hash buckets are uniform, so even a group holding a
third of all rows is spread over 65,536 tasks-worth of slices.

Cumulative distributions over values (KS, Wasserstein, Spearman ranks, exact
quantiles) first collapse rows to distinct values, so a repeated value is one
row; the distinct values are dealt by sampled ranges, so an outlier or a skewed
column does not crowd one task, and range totals give the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.sources.io import cut

_BUCKET_HEX = 4  # 16 bits of the md5 prefix -> 65,536 buckets


def hash_key(seed: int | str, *parts: str) -> Column:
    """md5 hex of ``seed|part1|...``: a reproducible pseudo-random order key."""
    items: list[Column] = [F.lit(str(seed))]
    for p in parts:
        items += [F.lit("|"), F.col(p).cast("string")]
    return F.md5(F.concat(*items))


def rank_within(
    df: DataFrame, groups: list[str], key: str, tiebreak: str, out: str = "_rank", total: str | None = None
) -> DataFrame:
    """1-based exact rank of each row inside ``groups`` ordered by (key, tiebreak).

    ``key`` must be a hex string column (uniform prefix). ``total`` optionally
    adds the group size.
    """
    bkt = F.conv(F.substring(F.col(key), 1, _BUCKET_HEX), 16, 10).cast("int")
    d = df.withColumn("__bkt", bkt)
    # counted map-side: only (groups, bucket) counts are shuffled here; the join
    # and the rank window share the one shuffle of the rows
    counts = d.groupBy(*groups, "__bkt").agg(F.count(F.lit(1)).alias("__n"))
    wg = Window.partitionBy(*groups).orderBy("__bkt")
    offs = counts.withColumn(
        "__off", F.coalesce(F.sum("__n").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    if total:
        offs = offs.withColumn(total, F.sum("__n").over(Window.partitionBy(*groups)))
    offs = offs.drop("__n")
    d = d.join(offs, [*groups, "__bkt"])
    wr = Window.partitionBy(*groups, "__bkt").orderBy(key, tiebreak)
    return d.withColumn(out, (F.col("__off") + F.row_number().over(wr)).cast("long")).drop("__bkt", "__off")


def order_cuts(df: DataFrame, labels: dict[str, str], ranks, seed: int = 42, id_col: str = "obs_id") -> DataFrame:
    """(task, class, cuts): the (key, id) at given ranks of the md5 order inside each class of each task's label column.

    ``ranks`` maps the class size (a column) to an array column of ascending
    ranks; rank 0 gives a cut below every key. Counts per key prefix (at most
    16**4 a class, written once) name the prefix that holds each rank, and only the rows of
    those prefixes are ranked: no pass shuffles the rows. One row per class.
    """
    tasks = F.array(*[F.struct(F.lit(t).alias("task"), F.col(c).alias("class"), _salted_key(seed, t, id_col).alias("__h")) for t, c in labels.items()])
    long = df.select(F.col(id_col).alias("__id"), F.explode(tasks).alias("t")).select("__id", "t.*").withColumn("__p", F.substring("__h", 1, _BUCKET_HEX))
    groups = Window.partitionBy("task", "class")
    counts = long.groupBy("task", "class", "__p").agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.withColumns({"__upto": F.sum("__n").over(groups.orderBy("__p").rowsBetween(Window.unboundedPreceding, 0)), "__total": F.sum("__n").over(groups)})
    counts = cut(counts.withColumn("__ranks", ranks(F.col("__total"))), "prefix-counts")
    sought = counts.select("task", "class", "__p", "__upto", "__n", "__total", F.posexplode("__ranks").alias("__j", "__rank"))
    edges = sought.where((F.col("__rank") > F.col("__upto") - F.col("__n")) & (F.col("__rank") <= F.col("__upto")))
    edges = edges.select(F.col("task").alias("__t"), F.col("class").alias("__c"), F.col("__p").alias("__e"), "__j", (F.col("__rank") - F.col("__upto") + F.col("__n")).alias("__left"))
    # as many rows as classes and ranks
    prefixes = F.broadcast(edges.select("__t", "__c", "__e").distinct())
    near = long.join(prefixes, (F.col("task") == F.col("__t")) & F.col("class").eqNullSafe(F.col("__c")) & (F.col("__p") == F.col("__e"))).drop("__t", "__c", "__e")
    near = near.withColumn("__place", F.row_number().over(Window.partitionBy("task", "class", "__p").orderBy("__h", "__id")))
    on = (F.col("task") == F.col("__t")) & F.col("class").eqNullSafe(F.col("__c")) & (F.col("__p") == F.col("__e")) & (F.col("__place") == F.col("__left"))
    found = near.join(F.broadcast(edges), on).select("__t", "__c", "__j", F.struct(F.col("__h").alias("h"), F.col("__id").cast("string").alias("id")).alias("__cut"))
    wanted = counts.select("task", "class", F.posexplode("__ranks").alias("__j2", "__rank")).distinct()
    cuts = wanted.join(found, (F.col("task") == F.col("__t")) & F.col("class").eqNullSafe(F.col("__c")) & (F.col("__j2") == F.col("__j")), "left")
    lowest = F.struct(F.lit("").alias("h"), F.lit("").alias("id"))
    listed = F.array_sort(F.collect_list(F.struct(F.col("__j2"), F.coalesce("__cut", lowest).alias("cut"))))
    return cuts.groupBy("task", "class").agg(F.transform(listed, lambda x: x["cut"]).alias("cuts"))


def _salted_key(seed: int | str, salt: str, id_col: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|{salt}|"), F.col(id_col).cast("string")))


def parts_by_cuts(df: DataFrame, cuts: DataFrame, labels: dict[str, str], names: dict[str, str], seed: int = 42, id_col: str = "obs_id") -> DataFrame:
    """df with, for each task, how many of its class's cuts lie before the row (column ``names[task]``): a filter against one row per class, no shuffle."""
    for task, label in labels.items():
        own = F.broadcast(cuts.where(F.col("task") == task).select(F.col("class").alias("__class"), F.col("cuts").alias("__cuts")))
        key = F.struct(_salted_key(seed, task, id_col).alias("h"), F.col(id_col).cast("string").alias("id"))
        df = df.withColumn("__key", key).join(own, F.col(label).eqNullSafe(F.col("__class")), "left")
        df = df.withColumn(names[task], F.size(F.filter("__cuts", lambda c: c < F.col("__key")))).drop("__key", "__class", "__cuts")
    return df


def n_test_rows(total: Column, test_size: float = 0.2) -> Column:
    """How many rows of a class of ``total`` are test rows."""
    return F.floor(total * test_size + 0.5)


def stratified_split(
    df: DataFrame, label: str, test_size: float = 0.2, seed: int = 42, salt: str = "", id_col: str = "obs_id"
) -> DataFrame:
    """Exact per-class split: the ``floor(test_size * n_c + 0.5)`` rows of each
    class with the smallest md5(seed|salt|id) go to ``test``."""
    return stratified_splits(df, {salt: label}, {salt: "split"}, test_size, seed, id_col)


def stratified_splits(df: DataFrame, labels: dict[str, str], names: dict[str, str], test_size: float = 0.2, seed: int = 42, id_col: str = "obs_id") -> DataFrame:
    """stratified_split for several label columns, each salted by its task: counts and cuts come from two scans of ids and labels, the rows from one more, and none is shuffled."""
    cuts = order_cuts(df.select(id_col, *dict.fromkeys(labels.values())), labels, lambda n: F.array(n_test_rows(n, test_size)), seed, id_col)
    done = parts_by_cuts(df, cuts, labels, names, seed, id_col)
    return done.withColumns({n: F.when(F.col(n) == 0, "test").otherwise("train") for n in names.values()})


def stratified_kfold(
    df: DataFrame, label: str, k: int = 5, seed: int = 42, salt: str = "", id_col: str = "obs_id"
) -> DataFrame:
    """Fold = (rank within class - 1) mod k on the md5 order (every fold stratified)."""
    d = df.withColumn("__salt", F.lit(salt)).withColumn("__h", hash_key(seed, "__salt", id_col))
    r = rank_within(d, [label], "__h", id_col, "__r")
    return r.withColumn("fold", ((F.col("__r") - 1) % k).cast("int")).drop("__salt", "__h", "__r")


def split_and_folds(df: DataFrame, labels: dict[str, str], names: dict[str, str], k: int = 5, test_size: float = 0.2, seed: int = 42, id_col: str = "obs_id") -> DataFrame:
    """df with, for each task, 0 for test rows and the fold 1..k of training rows, both stratified.

    A class's md5 order is cut after its test rows and then into k runs whose
    sizes differ by one at most. The order is random, so a run of it is as good
    a fold as every k-th row, and it needs no rank of each row.
    """

    def ranks(n: Column) -> Column:
        first = n_test_rows(n, test_size)
        return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: first + F.floor((n - first) * j / k))

    cuts = order_cuts(df.select(id_col, *dict.fromkeys(labels.values())), labels, ranks, seed, id_col)
    return parts_by_cuts(df, cuts, labels, names, seed, id_col)


def seeded_sample(df: DataFrame, n: int, seed: int = 42, id_col: str = "obs_id") -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement: the n smallest (md5 key, id).

    Counts per key prefix (at most 16**4 rows) name the prefix in which the n-th
    key lies; rows below it are taken by a filter, and only that prefix's rows
    are ranked.
    """
    d = df.withColumn("__h", hash_key(seed, id_col)).withColumn("__p", F.substring("__h", 1, _BUCKET_HEX))
    counts = d.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy().orderBy("__p").rowsBetween(Window.unboundedPreceding, 0))
    edge = counts.withColumn("__upto", upto).where(F.col("__upto") >= n)
    # one row; no prefix reaches n: all rows lie below the edge
    edge = edge.agg(F.coalesce(F.min("__p"), F.lit("g")).alias("__edge"), F.min_by(F.lit(n) - F.col("__upto") + F.col("__n"), "__p").alias("__left"))
    d = d.crossJoin(F.broadcast(edge))
    place = F.row_number().over(Window.partitionBy("__p").orderBy("__h", id_col))
    last = d.where("__p = __edge").withColumn("__place", place).where("__place <= __left").drop("__place")
    return d.where("__p < __edge").unionByName(last).select(*df.columns)


def sample_bounded(df: DataFrame, max_n: int, seed: int = 42, id_col: str = "obs_id") -> DataFrame:
    """All rows if n <= max_n, else an exact seeded sample of max_n (same rows either way)."""
    return seeded_sample(df, max_n, seed, id_col)


def shuffle(df: DataFrame, seed: int = 42, id_col: str = "obs_id") -> DataFrame:
    """Seeded full permutation: every row with its 1-based position."""
    d = df.withColumn("__h", hash_key(seed, id_col))
    return rank_within(d, [], "__h", id_col, "position").drop("__h")


def value_prefix(counts: DataFrame, group: str | list[str], value: str, sums: list[str]) -> DataFrame:
    """Running sums of ``sums`` over ascending ``value`` inside ``group``, plus
    ``next_value`` (the following distinct value, null for the last).

    ``counts`` holds one row per distinct (group, value). They are dealt by
    ranges of (group, value) and written, which fixes the ranges; totals of the
    ranges (one row per group and range) turn into offsets, and a window inside
    each (group, range) does the rest.
    """
    groups = [group] if isinstance(group, str) else group
    spread = max(2, int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    d = cut(counts.repartitionByRange(spread, *groups, value).withColumn("__b", F.spark_partition_id()), "value-ranges")
    bt = d.groupBy(*groups, "__b").agg(*[F.sum(s).alias(f"__t_{s}") for s in sums], F.min(value).alias("__first"))
    wb = Window.partitionBy(*groups).orderBy("__b")
    prev = wb.rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.select(
        *[F.col(g).alias(f"__g_{g}") for g in groups],
        F.col("__b").alias("__gb"),
        *[F.coalesce(F.sum(f"__t_{s}").over(prev), F.lit(0)).alias(f"__o_{s}") for s in sums],
        F.lead("__first").over(wb).alias("__next_first"),
    )
    on = F.col("__b") == F.col("__gb")
    for g in groups:
        on = on & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    d = d.join(bt, on)
    wv = Window.partitionBy(*groups, "__b").orderBy(value)
    run = wv.rowsBetween(Window.unboundedPreceding, 0)
    return d.select(
        *[c for c in counts.columns],
        *[(F.col(f"__o_{s}") + F.sum(s).over(run)).alias(f"cum_{s}") for s in sums],
        F.coalesce(F.lead(value).over(wv), F.col("__next_first")).alias("next_value"),
    )


def quantile_of(value: str, cum: str, total: str, q: float) -> Column:
    """Aggregate over a ``value_prefix`` frame: the linearly interpolated ``q``-quantile.

    The value at 0-based place k is the least one with more than k rows up to it.
    """
    place = (F.col(total) - 1) * F.lit(float(q))
    low = F.min(F.when(F.col(cum) > F.floor(place), F.col(value)))
    high = F.min(F.when(F.col(cum) > F.ceil(place), F.col(value)))
    return low + (high - low) * F.max(place - F.floor(place))


def exact_quantiles(df: DataFrame, groups: list[str], columns: list[str], probs: dict[str, float]) -> DataFrame:
    """(groups, column, one field per name in ``probs``): exact quantiles of the
    non-null values of each column, without holding a group's values in one task."""
    long = df.select(*groups, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(groups, columns, "column", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy(*groups, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    keys = [*groups, "column"]
    pre = value_prefix(counts, keys, "value", ["n"])
    totals = pre.groupBy(*keys).agg(F.max("cum_n").alias("__total")).select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__total")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return pre.join(totals, on).groupBy(*keys).agg(*[quantile_of("value", "cum_n", "__total", q).alias(n) for n, q in probs.items()])


def average_ranks(df: DataFrame, group: str, value: str) -> DataFrame:
    """Average (fractional) rank of each distinct value within ``group``:
    rank = rows below + (ties + 1) / 2. Returns (group, value, avg_rank)."""
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    pre = value_prefix(counts, group, value, ["n"])
    return pre.select(group, value, (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2.0).alias("avg_rank"))
