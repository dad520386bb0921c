"""Sources and sinks (group A): explicit schemas, shared-storage outputs.

Every sink writes under the cluster's shared ``spark.checkpoint.dir``, read
from the session. It must be set on a cluster; a single local JVM that leaves
it unset gets a folder of its own for the session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool import schema as S


def shared_root(spark: SparkSession) -> str:
    """The library's folder below the cluster's shared one."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset: it must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidepool-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tidepool"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own for one result."""
    return f"{shared_root(spark)}/{name}/{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: computed once, lineage ends at the files."""
    path = shared_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of one partition of a shuffle of whole rows: its sort stays in memory at any table size.
PARTITION_ROWS = 500_000


def row_partitions(spark: SparkSession, rows: int) -> int:
    """How many partitions a shuffle of so many rows takes: the session's number, more for large tables."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PARTITION_ROWS))


def require_columns(df: DataFrame, required: list[str] = S.REQUIRED_COLUMNS) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def read_observations_csv(spark: SparkSession, path: str, schema: T.StructType = S.OBSERVATION_SCHEMA) -> DataFrame:
    """CSV files with a header and the declared schema (no inference), and `broken_line`: the text of a line that does not parse, else null.

    The header must name the schema's columns in order. A broken line keeps what
    can be read; a number or time that cannot be is null.
    """
    header = spark.read.option("header", True).csv(path).columns
    require_columns(spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in header])), schema.names)
    if header != schema.names:
        raise ValueError(f"unexpected columns: {header}")
    full = T.StructType([*schema.fields, T.StructField("broken_line", T.StringType())])
    rows = spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "broken_line").csv(path)
    # Spark converts only the fields that are read: the line's text is made to need them all
    nothing = F.substring(F.xxhash64(*schema.names).cast("string"), 1, 0)
    return rows.withColumn("broken_line", F.concat("broken_line", nothing))


def read_json_files(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Files that each hold one JSON object or a list of objects: (path, file_name, modified, readable, place, record), newest file first by time.

    `record` is the objects' schema (DDL). A file that is blank or does not parse
    is one row with readable = false and a null record; an empty list has one
    with readable = true; Spark lists no file of zero bytes. Each file is read as a whole, so these are for
    documents and receipts, not for tables.
    """
    files = spark.read.format("binaryFile").load(path)
    text = files.select(F.decode("content", "UTF-8").alias("value"), "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("modificationTime").alias("modified"))
    body = F.btrim("value", F.lit(" \t\r\n"))
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    whole = F.from_json(F.concat(F.lit('{"r":'), F.when(body.startswith("["), body).otherwise(F.concat(F.lit("["), body, F.lit("]"))), F.lit("}")), f"r array<struct<{record}>>, _corrupt string", how)
    parsed = text.withColumn("_p", F.when(body != "", whole))
    ok = F.col("_p").isNotNull() & F.col("_p._corrupt").isNull() & F.col("_p.r").isNotNull()
    rows = parsed.select("path", "file_name", "modified", ok.alias("readable"), F.posexplode_outer(F.when(ok, F.col("_p.r"))).alias("place", "record"))
    return rows.orderBy(F.desc("modified"), "path", "place")


def parse_timestamps(df: DataFrame, col: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Text -> timestamp; unparseable -> null (coerce)."""
    return df.withColumn(col, F.try_to_timestamp(F.col(col), F.lit(fmt)))


def write_partitioned(df: DataFrame, path: str, partition_by: list[str]) -> str:
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return path


def write_if_valid(df: DataFrame, violations: DataFrame, path: str) -> bool:
    """Write the table only when there are zero violations (one cheap probe)."""
    if violations.limit(1).count() > 0:
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_summary_json(df: DataFrame, path: str) -> str:
    """One nested summary document per row, as JSON lines."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)
    return path


def read_receipts(spark: SparkSession, path_glob: str, schema: str) -> DataFrame:
    """Receipt files by glob, newest first by modification time: one row per receipt with its file's name and time; unreadable files are left out."""
    found = read_json_files(spark, path_glob, schema).where("readable and record is not null")
    return found.select("record.*", "file_name", "modified").orderBy(F.desc("modified"), "file_name")


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive table fingerprint: row count plus two sums of 60 bits each of per-row md5 values (differs from an order-sensitive file hash)."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("\u0001")) for c in df.columns]
    h = F.md5(F.concat_ws("|", *cols))
    part = [F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 17)]
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(p).cast("string").alias(f"hash_sum_{n}") for p, n in zip(part, "ab")])
