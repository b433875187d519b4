"""Scans: raw CSV with an explicit schema, landing, profiles, checksums and parameterised SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.sources.schema import CORRUPT, RAW_COLUMNS


def read_raw_csv(
    spark: SparkSession, path: str, types: dict[str, str] | None = None, keep_corrupt: bool = False
) -> DataFrame:
    """Read raw CSV files (one file, a folder or a glob) whose headers carry spaces.

    The header of the first file gives the column order, so extra columns are kept as text; the 21 known
    columns get their declared type and snake_case name. ``types`` overrides a declared type by raw name,
    for example ``{"senior_citizen": "int"}`` for sources that code it 0/1. With ``keep_corrupt`` a row with
    too many or too few fields has its text in ``corrupt_record``, which is NULL elsewhere; the validation report counts it.
    """
    types = types or {}
    known = {header: (raw, types.get(raw, kind)) for header, raw, _, kind in RAW_COLUMNS}
    headers = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(h, T.StringType()) for h in [*headers, CORRUPT]])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    text = reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    columns = []
    for header in headers:
        name, kind = known.get(header, (header.lower().replace(" ", "_"), "string"))
        column = F.col(f"`{header}`")
        columns.append((column if kind == "string" else column.try_cast(kind)).alias(name))
    return text.select(*columns, *([CORRUPT] if keep_corrupt else []))


def land(spark: SparkSession, source_glob: str, landing: str) -> DataFrame:
    """Land raw CSV files as Parquet once; a landing that already exists is kept as it is."""
    read_raw_csv(spark, source_glob, keep_corrupt=True).write.mode("ignore").parquet(landing)
    return spark.read.parquet(landing)


def profile(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count("*").alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("bigint")
    )


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 per landing file with its size and time. One task reads one whole file, and Spark refuses
    files over ``spark.sql.sources.binaryFile.maxLength`` (2 GB); tables use ``fingerprint`` instead."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            "path",
            F.col("length").alias("n_bytes"),
            F.col("modificationTime").alias("modified_at"),
            F.sha2("content", 256).alias("sha256"),
        )
    )


def fingerprint(df: DataFrame) -> DataFrame:
    """Content checksum of a table that does not depend on row order or partitioning: the row count and the sums of
    the four 32-bit words of each row's MD5. Each field goes in with its length, so that no two rows share a text, and
    NULL has a mark of its own; doubles go in with all their digits. One pass with partial sums, no shuffle of rows."""
    texts = [F.col(name).cast("string") for name in df.columns]
    fields = [F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    digest = F.md5(F.concat(*fields))
    words = [F.conv(F.substring(digest, at, 8), 16, 10).cast("decimal(20,0)") for at in (1, 9, 17, 25)]
    sums = df.select(*[w.alias(f"w{k}") for k, w in enumerate(words)]).agg(
        F.count("*").alias("row_count"), *[F.sum(f"w{k}").cast("string").alias(f"s{k}") for k in range(4)]
    )
    return sums.select("row_count", F.concat_ws("-", "s0", "s1", "s2", "s3").alias("content_sum"))
