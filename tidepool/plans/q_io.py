"""Group A queries: scans, parsing and sinks (sinks write to the shared checkpoint dir and read back)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool import schema as S
from tidepool.operators import ordered as O
from tidepool.operators import scalar as B
from tidepool.plans import q_drift, q_ml, q_ordered
from tidepool.plans.registry import register
from tidepool.sources import fixtures as X
from tidepool.sources import io as IO


@register("scan_observations", "SELECT * FROM observations")
def scan_observations(spark, sf_dir):
    """Scan with the required-column check (raises on a missing column)."""
    return IO.require_columns(X.observations(spark, sf_dir))


@register(
    "parse_timestamps",
    """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 97 = 0 THEN 'not a date'
                                      ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS parsed
    FROM orders""",
)
def parse_timestamps(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 97 == 0, F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    df = o.select("o_orderkey", text.alias("parsed"))
    return IO.parse_timestamps(df, "parsed").withColumn("parsed", F.col("parsed").cast("timestamp_ntz"))


_BROKEN = "_ep % 101 = 7"


@register(
    "scan_observations_csv",
    f"""SELECT o.obs_id, o.timestamp, o.region, o.latitude, o.longitude, {", ".join(f"CASE WHEN {_BROKEN} THEN NULL ELSE b.ph END AS ph" if c == "ph" else f"o.{c}" for c in S.SENSOR_COLUMNS)},
        {", ".join(f"o.{c}" for c in S.TARGET_COLUMNS)}, {_BROKEN} AS broken FROM observations o JOIN obs_base b USING (obs_id)""",
)
def scan_observations_csv(spark, sf_dir):
    """The observations written as CSV, one line of a hundred with a word for a number, and read back with the declared schema."""
    base = X.labelled_base(spark, sf_dir)
    text = base.withColumn("ph", F.when(F.expr(_BROKEN), "n/a").otherwise(F.col("ph").cast("string"))).select(*S.OBSERVATION_COLUMNS)
    path = IO.shared_dir(spark, "observations-csv")
    # as text the rows are four times the table at rest; a compressed file is read by one task, and there are as many as partitions
    text.write.option("header", True).option("compression", "gzip").csv(path)
    found = IO.read_observations_csv(spark, path)
    return found.withColumn("broken", F.col("broken_line").isNotNull()).drop("broken_line")


@register(
    "scan_json_records",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def scan_json_records(spark, sf_dir):
    ev = X.table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.k")


#: Events of one file of scan_json_files.
_FILE_EVENTS = 200


@register(
    "scan_json_files",
    f"""WITH e AS (SELECT event_id // {_FILE_EVENTS} AS file, event_id, event_type, value FROM events),
    f AS (SELECT file, min(event_id) AS first FROM e GROUP BY file)
    SELECT e.file, true AS readable, event_id, event_type, value FROM e JOIN f USING (file) WHERE file % 7 NOT IN (3, 4) AND (file % 7 <> 1 OR event_id = first)
    UNION ALL SELECT file, false, NULL, NULL, NULL FROM f WHERE file % 7 IN (3, 4)""",
)
def scan_json_files(spark, sf_dir):
    """Events written as one JSON document a file, read back as rows, newest file first. Of seven files one holds a single object, one is cut short and one is empty."""
    ev = X.table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.floor(F.col("event_id") / _FILE_EVENTS).alias("file"))
    kind = F.col("file") % 7
    doc = F.array_sort(F.collect_list(F.struct("event_id", "event_type", "value")))
    files = ev.groupBy("file").agg(doc.alias("doc"))  # _FILE_EVENTS events each
    whole = F.to_json("doc")
    text = F.when(kind == 1, F.to_json(F.col("doc")[0])).when(kind == 3, F.expr("substring(to_json(doc), 1, length(to_json(doc)) - 9)")).when(kind == 4, "").otherwise(whole)
    path = IO.shared_dir(spark, "json-files")
    files.select("file", text.alias("value")).write.partitionBy("file").text(path)
    found = IO.read_json_files(spark, f"{path}/file=*", "event_id long, event_type string, value double")
    return found.select(F.regexp_extract("path", "file=([0-9]+)", 1).cast("long").alias("file"), "readable", "record.event_id", "record.event_type", "record.value")


@register(
    "evaluation_best_model",
    f"""WITH m AS ({q_ml.ORACLE_BODIES["model_metrics"]})
    SELECT task, algorithm AS best_model_name, macro_f1, balanced_accuracy, accuracy FROM m
    QUALIFY row_number() OVER (PARTITION BY task ORDER BY macro_f1 DESC, balanced_accuracy DESC, algorithm DESC) = 1""",
)
def evaluation_best_model(spark, sf_dir):
    """Nested evaluation document (map algorithm -> metrics) serialised to
    JSON, parsed back, and the best model's metrics looked up by name."""
    m = q_ml.model_metrics(spark, sf_dir)
    doc = m.groupBy("task").agg(
        F.max_by("algorithm", F.struct("macro_f1", "balanced_accuracy", "algorithm")).alias("best_model_name"),
        F.map_from_entries(F.collect_list(F.struct("algorithm", F.struct("macro_f1", "balanced_accuracy", "accuracy")))).alias("models"),
    )
    js = doc.select("task", F.to_json(F.struct("best_model_name", "models")).alias("json"))
    schema = "best_model_name string, models map<string, struct<macro_f1: double, balanced_accuracy: double, accuracy: double>>"
    parsed = js.select("task", F.from_json("json", schema).alias("d"))
    best = F.element_at("d.models", F.col("d.best_model_name"))
    return parsed.select(
        "task",
        F.col("d.best_model_name").alias("best_model_name"),
        F.round(best["macro_f1"], 6).alias("macro_f1"),
        F.round(best["balanced_accuracy"], 6).alias("balanced_accuracy"),
        F.round(best["accuracy"], 6).alias("accuracy"),
    )


@register(
    "write_splits",
    "WITH s AS (" + q_ordered.split_sql() + f""")
    SELECT task, split, part, class, count(*) AS rows, CASE part WHEN 'X' THEN {len(S.ALL_FEATURES)} ELSE 1 END AS columns
    FROM s, (VALUES ('X'), ('y')) p(part) GROUP BY ALL""",
)
def write_splits(spark, sf_dir):
    """Features (derived ones included) and targets of each task and split, written apart and read back; X and y meet by their key, not by their order."""
    obs = B.add_derived_features(X.observations(spark, sf_dir))
    names = {t: f"__{t}" for t in S.TASK_TARGET}
    done = O.stratified_splits(obs, S.TASK_TARGET, names)
    out = None
    for t, label in S.TASK_TARGET.items():
        tables = {}
        for part, cols in (("X", S.ALL_FEATURES), ("y", [label])):
            path = IO.write_partitioned(done.select("obs_id", F.col(names[t]).alias("split"), *cols), IO.shared_dir(spark, f"splits-{t}-{part}"), ["split"])
            tables[part] = spark.read.parquet(path)
        # no task's sort of keys spills, however many rows
        parts = IO.row_partitions(spark, tables["y"].count())
        y = tables["y"].select("obs_id", "split", F.col(label).alias("class")).repartition(parts, "obs_id")
        for part, table in tables.items():
            n = len(table.columns) - 2  # without key and split
            # counting the key keeps the check that every row has a partner; y is used
            # with all its columns, so that it is shuffled once for both its sides and for X
            if part == "X":
                both, key = B.paired(table.select("obs_id").repartition(parts, "obs_id"), y, "obs_id"), F.col("obs_id")
            else:
                both = B.paired(y, y, "obs_id").toDF("obs_id", "_split", "_class", "split", "class")
                key = F.when(F.col("obs_id").isNotNull(), F.coalesce("_split", "_class", "obs_id"))
            own = both.groupBy("split", "class").agg(F.count(key).alias("rows"))
            own = own.select(F.lit(t).alias("task"), "split", F.lit(part).alias("part"), "class", "rows", F.lit(n).alias("columns"))
            out = own if out is None else out.unionByName(own)
    return out


@register(
    "write_if_valid",
    """SELECT 'clean' AS input, count(*) AS rows, true AS written FROM observations UNION ALL SELECT 'damaged', 0, false""",
)
def write_if_valid(spark, sf_dir):
    """The table is written only when validation finds no violation: a clean input, and a damaged one."""
    from tidepool.operators import validate as VL

    out = []
    for name, obs in (("clean", X.observations(spark, sf_dir)), ("damaged", X.observations_dirty(spark, sf_dir).select(*S.OBSERVATION_COLUMNS))):
        path = IO.shared_dir(spark, "validated")
        written = IO.write_if_valid(obs, VL.validate_all(spark, obs), path)
        rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")) if written else spark.createDataFrame([(0,)], "rows long")
        out.append(rows.select(F.lit(name).alias("input"), "rows", F.lit(written).alias("written")))
    return out[0].unionByName(out[1])


@register(
    "write_window",
    "SELECT 'reference' AS \"window\", obs_id FROM ref_window UNION ALL SELECT 'production', obs_id FROM prod_window",
)
def write_window(spark, sf_dir):
    ref, cur = q_drift.windows(spark, sf_dir)
    p1, p2 = IO.shared_dir(spark, "reference_window"), IO.shared_dir(spark, "production_window")
    ref.write.mode("overwrite").parquet(p1)
    cur.write.mode("overwrite").parquet(p2)
    return spark.read.parquet(p1).select(F.lit("reference").alias("window"), "obs_id").unionByName(
        spark.read.parquet(p2).select(F.lit("production").alias("window"), "obs_id")
    )


@register("write_summary_json", q_drift.SUMMARY_SQL)
def write_summary_json(spark, sf_dir):
    """The drift summary as one JSON document, read back with its schema."""
    s = q_drift.drift_summary(spark, sf_dir)
    path = IO.write_summary_json(s, IO.shared_dir(spark, "drift_summary"))
    return spark.read.schema(s.schema).json(path)


@register(
    "receipts_latest",
    f"""SELECT task, algorithm, passed, failures FROM ({q_ml.ORACLE_BODIES["quality_gate"]})""",
)
def receipts_latest(spark, sf_dir):
    """A10: append-only receipts, one file a gate decision, newest first by time; a file that is no JSON is skipped."""
    g = q_ml.quality_gate(spark, sf_dir).select("task", "algorithm", F.to_json(F.struct("task", "algorithm", "passed", "failures")).alias("value"))
    base = IO.shared_dir(spark, "receipts")
    torn = spark.createDataFrame([("none", "torn", '{"task": "health", "algori')], "task string, algorithm string, value string")
    g.unionByName(torn).write.partitionBy("task", "algorithm").text(base)
    found = IO.read_receipts(spark, f"{base}/task=*/algorithm=*", "task string, algorithm string, passed boolean, failures string")
    return found.select("task", "algorithm", "passed", "failures")


_COLS = [f"coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S'), chr(1))" if c == "timestamp" else f"coalesce({c}, chr(1))" for c in ("obs_id", "timestamp", "region", *S.TARGET_COLUMNS)]
_FINGERPRINT_SQL = f"""WITH h AS (SELECT md5({" || '|' || ".join(_COLS)}) AS h FROM observations)
    SELECT count(*) AS rows, sum(('0x' || substr(h, 1, 15))::HUGEINT)::VARCHAR AS hash_sum_a, sum(('0x' || substr(h, 17, 15))::HUGEINT)::VARCHAR AS hash_sum_b FROM h"""


@register("dataset_fingerprint", _FINGERPRINT_SQL)
def dataset_fingerprint(spark, sf_dir):
    """A11 over the columns whose text form no engine disputes."""
    return IO.fingerprint(X.observations(spark, sf_dir).select("obs_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "region", *S.TARGET_COLUMNS))


@register(
    "file_profile",
    f"""WITH f AS ({_FINGERPRINT_SQL}), p AS (SELECT rows, hash_sum_a, hash_sum_b, substr(sha256(rows || '|' || hash_sum_a || '|' || hash_sum_b), 1, 12) AS checksum_prefix FROM f)
    SELECT *, 5 AS columns, true AS as_expected FROM p""",
)
def file_profile(spark, sf_dir):
    """Rows, columns and checksum of the table, compared with those of a written copy."""
    named = X.observations(spark, sf_dir).select("obs_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "region", *S.TARGET_COLUMNS)

    def profile(df):
        return IO.fingerprint(df).withColumns({"columns": F.lit(len(df.columns)), "checksum_prefix": F.substring(F.sha2(F.concat_ws("|", "rows", "hash_sum_a", "hash_sum_b"), 256), 1, 12)})

    copy = profile(IO.cut(named, "profiled")).select(F.col("checksum_prefix").alias("_copied"), F.col("columns").alias("_columns"))
    both = profile(named).crossJoin(copy)  # one row each
    return both.withColumn("as_expected", (F.col("checksum_prefix") == F.col("_copied")) & (F.col("columns") == F.col("_columns"))).drop("_copied", "_columns")
