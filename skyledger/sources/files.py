"""Delimited files: read, project, type, number and profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import now, strip, try_date
from ..schemas import text_schema
from .records import fields, plain_path, split_records
from .tables import written


def read_csv(spark: SparkSession, path: str | list[str], schema, row_number: str | None = None) -> DataFrame:
    """Delimited files with a header, every column as text, found by its name in the header of its file.

    Quoted fields may hold line breaks, and files are read in many splits all the same (``records``). A byte-order mark is
    dropped; an empty field and a column that a file lacks are NULL. With ``row_number`` a column of that name numbers the
    records of each file from 2 on.
    """
    wanted = schema if isinstance(schema, T.StructType) else text_schema(schema)
    found = split_records(spark, path)
    header = written(found.where("number = 1").select("path", fields("record").alias("_names")), "headers")
    rows = found.where("number > 1").join(header, "path").withColumn("_fields", fields("record"))
    out = [] if row_number is None else [F.col("number").alias(row_number)]
    for f in wanted.fields:
        text = F.nullif(F.get("_fields", (F.array_position("_names", f.name) - 1).cast("int")), F.lit(""))
        out.append((text if isinstance(f.dataType, T.StringType) else text.try_cast(f.dataType)).alias(f.name))
    return rows.select(*out)


def read_csv_lines(spark: SparkSession, path: str | list[str], schema) -> DataFrame:
    """The same where each record is known to be one line and the header to be the schema: one scan and no other pass."""
    wanted = schema if isinstance(schema, T.StructType) else text_schema(schema)
    reader = spark.read.schema(wanted).option("header", True).option("escape", '"').option("enforceSchema", False)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.csv(path)


def project_raw(df: DataFrame, rename: dict[str, str], columns) -> DataFrame:
    """Rename source columns and keep the allow-list; an absent column is NULL, an extra one is dropped."""
    source_of = {new: old for old, new in rename.items()}
    out = []
    for name in columns:
        source = source_of.get(name, name)
        if source in df.columns:
            out.append(F.col(source).alias(name))
        else:
            out.append(F.lit(None).cast("string").alias(name))
    return df.select(*out)


def coerce_int(c: Column | str) -> Column:
    """Whole number from text; anything else is NULL."""
    number = (F.col(c) if isinstance(c, str) else c).try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def coerce_ints(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({name: coerce_int(name) for name in cols if name in df.columns})


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns to their declared types; unreadable values are NULL, other columns stay."""
    return df.withColumns({name: _typed(name, kind) for name, kind in types.items() if kind != "string"})


def _typed(name: str, kind: str) -> Column:
    if kind == "int":
        return coerce_int(name)
    if kind == "double":
        return F.col(name).try_cast("double")
    if kind == "date":
        return try_date(name)
    return strip(name).try_cast(kind)


def with_lineage(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Add the file a row came from and its load time; call it right after the scan."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        (now() if loaded_at is None else loaded_at).alias("loaded_at"),
    )


def with_row_number(df: DataFrame, name: str = "row_number") -> DataFrame:
    """Number the rows of a scan by file, from 2 on (the header is line 1); call it right after the scan.

    No row is shuffled. Row positions inside a scan follow ``monotonically_increasing_id``; a first
    pass counts the rows of every file block, and a running sum over the blocks of a file gives the
    number at which each block starts. The block table has one short row per block and is written, so Spark
    chooses the join by its size. Both passes must cut the files alike, so keep
    the ``spark.sql.files`` settings; a block that the first pass did not see fails the job.
    """
    position = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
    )
    blocks = position.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_pos").alias("_first")
    )
    running = F.expr("sum(_rows) over (partition by _file order by _block rows unbounded preceding) - _rows")
    starts = written(blocks.select("_file", "_block", "_first", running.alias("_before")), "blocks")
    number = F.col("_pos") - F.col("_first") + F.col("_before") + 2
    unseen = F.raise_error(F.lit("file blocks changed between the two passes")).cast("bigint")
    return (
        position.join(starts, ["_file", "_block"], "left")
        .withColumn(name, F.when(F.col("_first").isNull(), unseen).otherwise(number))
        .drop("_file", "_block", "_pos", "_first", "_before")
    )


def list_files(spark: SparkSession, path: str | list[str], glob: str = "*.csv") -> DataFrame:
    """Path, size and modification time of files, without reading them."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(plain_path("path").alias("path"), "length", "modificationTime")
    )


def latest_file(spark: SparkSession, folder: str, glob: str = "*.csv") -> str | None:
    """The last file of a folder by name, or None when there is none."""
    return list_files(spark, folder, glob).agg(F.max("path")).first()[0]


def profile_files(spark: SparkSession, path: str | list[str], required: list[str], source_name: str) -> DataFrame:
    """Size, checksum, record count, missing required columns and status of each file.

    Records are those of ``records``: quoted line breaks do not end them, blank lines are none. The checksum is one of the
    content, the same for files of every size: the MD5 of the size and the sum of the first 60 bits of the MD5 of each
    numbered record, so it changes with their order too and no file becomes one row. The header is the whole first
    record, whatever its length.
    """
    files = list_files(spark, path)
    records = split_records(spark, path, "*.csv")
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", "number", "record")), 1, 15), 16, 10)
    counts = records.groupBy("path").agg(
        (F.count(F.lit(1)) - 1).alias("row_count"),
        F.sum(bits.cast("decimal(38,0)")).alias("content"),
        F.max(F.when(F.col("number") == 1, F.col("record"))).alias("header_record"),
    )
    wanted = F.array(*[F.lit(name) for name in sorted(required)])
    header = F.coalesce(fields("header_record"), F.array().cast("array<string>"))
    return (
        files.join(counts, "path", "left")
        .select(
            F.lit(source_name).alias("source_name"),
            F.col("path").alias("file_path"),
            F.col("length").alias("file_size_bytes"),
            F.md5(F.concat_ws("|", "length", F.coalesce("content", F.lit(0).cast("decimal(38,0)")))).alias("checksum_md5"),
            F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
            F.array_except(wanted, header).alias("missing_columns"),
        )
        .withColumn(
            "status",
            F.when((F.size("missing_columns") > 0) | (F.col("row_count") == 0), "FAILED").otherwise("PASSED"),
        )
    )
