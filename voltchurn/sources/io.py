"""Sources and sinks.

Readers take explicit schemas (no inference on the hot path); CSV text
columns that the pipeline coerces later stay strings, so bad values become
NULL where they are used (``try_cast``), as the reference's ``errors="coerce"``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltchurn.sources import schemas as SC


CORRUPT = "_corrupt_record"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its file system (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header and a declared schema; malformed rows keep NULLs (PERMISSIVE)."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    return (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None,
              multiline: bool = True) -> DataFrame:
    """A JSON document of records (array) or one object per line."""
    r = spark.read.option("multiLine", multiline)
    return (r.schema(schema) if schema is not None else r).json(path)


def read_checked(spark: SparkSession, path: str, schema: T.StructType, kind: str = "csv", header: bool = True,
                 multiline: bool = True) -> DataFrame:
    """The rows of a CSV or JSON file with ``_corrupt_record``.

    A row that does not fit the declared columns (a value that cannot be read as
    its type, too few or too many fields, a broken record) keeps what could be
    read and its raw text in ``_corrupt_record``; it is NULL for a good row.
    """
    r = spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])) \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return r.option("header", header).csv(path) if kind == "csv" else r.option("multiLine", multiline).json(path)


def quarantine(spark: SparkSession, path: str, schema: T.StructType | str, out: str, kind: str = "csv", header: bool = True,
               multiline: bool = True) -> tuple[DataFrame, DataFrame]:
    """(clean rows, corrupt rows) of a raw file, written side by side under ``out``.

    The file is parsed once, into a table partitioned by ``is_corrupt``.  Clean
    rows have the declared columns; corrupt ones their raw text and file.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = read_checked(spark, path, schema, kind, header, multiline)
    marked = rows.withColumns({"is_corrupt": F.col(CORRUPT).isNotNull(), "source_file": F.col("_metadata.file_path")})
    marked.write.mode("overwrite").partitionBy("is_corrupt").parquet(out)
    table = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("source_file", T.StringType()),
                                            T.StructField("is_corrupt", T.BooleanType())])).parquet(out)
    return table.where(~F.col("is_corrupt")).select(*schema.names), table.where("is_corrupt").select(CORRUPT, "source_file")


def load_checked_datasets(spark: SparkSession, data_dir: str, out_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """S1 + S12: the raw tables' clean rows and their corrupt ones, by logical name."""
    clean, bad = {}, {}
    for key, (fname, schema) in SC.RAW_FILES.items():
        kind = "json" if fname.endswith(".json") else "csv"
        clean[key], bad[key] = quarantine(spark, f"{data_dir.rstrip('/')}/{fname}", schema, f"{out_dir.rstrip('/')}/{key}", kind)
    return clean, bad


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs -> dotted top-level columns (like ``json_normalize``)."""
    def walk(dtype, prefix):
        out = []
        for f in dtype.fields:
            name = f"{prefix}{sep}{f.name}" if prefix else f.name
            if isinstance(f.dataType, T.StructType):
                out += walk(f.dataType, name)
            else:
                out.append(name)
        return out

    cols = walk(df.schema, "")
    return df.select(*[F.col("`" + c.replace(sep, "`.`") + "`").alias(c) if sep in c else F.col(f"`{c}`")
                       for c in cols])


def load_raw_datasets(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """The six raw tables by logical name (five CSV files and one JSON document)."""
    out = {}
    for key, (fname, schema) in SC.RAW_FILES.items():
        path = f"{data_dir.rstrip('/')}/{fname}"
        out[key] = read_json(spark, path, schema) if fname.endswith(".json") else read_csv(spark, path, schema)
    return out


def load_or_convert_consumption(spark: SparkSession, data_dir: str, stem: str = "consumption_hourly_2024",
                                partitions: int | None = None) -> DataFrame:
    """S2 + S3: parquet if present, else CSV(.gz) converted once to parquet, else an error.

    A gzip CSV is one unsplittable task, so it is spread before the write;
    the parquet copy is partitioned by month for later pruning.  A copy counts
    as present once its writer committed it; a half-written one is made anew.
    """
    base = data_dir.rstrip("/")
    pq = f"{base}/{stem}.parquet"
    if path_exists(spark, f"{pq}/_SUCCESS"):       # a folder without it was left by an aborted write
        return spark.read.parquet(pq)
    for cand in (f"{base}/{stem}.csv.gz", f"{base}/{stem}.csv"):
        if path_exists(spark, cand):
            df = read_csv(spark, cand, SC.CONSUMPTION)
            df = df.repartition(partitions or spark.sparkContext.defaultParallelism)
            df = df.withColumn("month", F.substring("timestamp", 1, 7))
            df.write.mode("overwrite").partitionBy("month").parquet(pq)
            return spark.read.parquet(pq)
    raise FileNotFoundError(f"Consumption file not found in {data_dir}")


def read_parquet(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Parquet scan; a column list is pruned at the scan (no batching needed)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> None:
    """Parquet sink."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json_record(df: DataFrame, path: str) -> None:
    """A small report table written as JSON records (one file)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export with header; arrays are joined with ``|``."""
    cols = [F.array_join(F.col(f.name), "|").alias(f.name) if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name) for f in df.schema.fields]
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a layer, or an empty table of the given schema when it does not exist."""
    if path_exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def read_report(spark: SparkSession, path: str) -> DataFrame | None:
    """A JSON report (metrics, drift results) or None when missing."""
    return spark.read.json(path) if path_exists(spark, path) else None


def pipeline_runs(spark: SparkSession, path: str, status: str | None = None) -> DataFrame:
    """S15 + E22: run history newest first, optionally one status."""
    schema = "run_id string, file_key string, status string, started_at timestamp, completed_at timestamp"
    df = spark.read.schema(schema).json(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    if status and status != "All":
        df = df.filter(F.col("status") == status)
    return df.orderBy(F.desc("started_at"), "run_id")
