"""Incremental file ingestion: load each landed file exactly once.

The reference's ``COPY INTO`` skips files it has already loaded.  On Spark
this is a file-source stream with ``trigger(availableNow=True)``: the stream's
checkpoint remembers which files were read, every run processes all files that
arrived since the last one (split into bounded micro-batches) and stops.  The
parquet sink commits each batch through its own log, so a retried or
restarted run neither duplicates nor drops rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

#: Columns of a table that keeps malformed lines: the partition they are in, the line and its file.
MALFORMED, RAW_LINE, RAW_FILE = "Malformed", "RawLine", "RawFile"


def unclosed_quote(line: Column) -> Column:
    """Whether a field of the line begins with a quote that never ends."""
    return F.regexp_replace(line, '"[^"]*"', "").rlike('(^|,)"')


def parse_lines(lines: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` parsed from the text column ``RawLine``, with ``Malformed``.

    Malformed are lines with too few or too many fields or an unclosed quote; they
    keep their text, well-formed ones drop it.  Other columns stay.
    """
    bad = "_malformed"
    fields = StructType([*schema.fields, StructField(bad, StringType())])
    parsed = lines.withColumn("_p", F.from_csv(RAW_LINE, fields.simpleString()[len("struct<"):-1].replace(":", " "),
                                               {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}))
    broken = F.col(f"_p.{bad}").isNotNull() | unclosed_quote(F.col(RAW_LINE))
    others = [c for c in lines.columns if c != RAW_LINE]
    return parsed.withColumn(MALFORMED, broken).select(
        *[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields], *others,
        F.when(F.col(MALFORMED), F.col(RAW_LINE)).alias(RAW_LINE), MALFORMED)


def stream_lines(spark: SparkSession, source_dir: str, header: bool, recursive: bool, max_files_per_trigger: int | None) -> DataFrame:
    """``RawLine`` (every line but the files' headers, unparsed) and ``RawFile``."""
    whole = "_whole"  # a line that holds the separator itself
    r = (spark.readStream.schema(f"{RAW_LINE} string, {whole} string").format("csv").option("header", header).option("mode", "PERMISSIVE")
         .option("sep", "\x01").option("quote", "").option("columnNameOfCorruptRecord", whole))
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(source_dir).select(F.coalesce(whole, RAW_LINE).alias(RAW_LINE), F.col("_metadata.file_path").alias(RAW_FILE))


def stream_files(spark: SparkSession, source_dir: str, schema, fmt: str = "csv", header: bool = True,
                 recursive: bool = False, max_files_per_trigger: int | None = None,
                 lineage: bool = False) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", header).option("mode", "PERMISSIVE")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(source_dir)
    if lineage:
        df = df.withColumns({"IngestionDate": F.current_timestamp(),
                             "SourceFile": F.col("_metadata.file_path")})
    return df


def load_incremental(spark: SparkSession, source_dir: str, schema, target_path: str, checkpoint: str,
                     fmt: str = "csv", header: bool = True, recursive: bool = False,
                     lineage: bool = False, max_files_per_trigger: int | None = None, quarantine: bool = False) -> DataFrame:
    """Append every not-yet-loaded file of ``source_dir`` to the parquet table at
    ``target_path``; returns a batch scan of the whole table afterwards.

    With ``quarantine`` (CSV) malformed lines go to a partition of their own in the same
    commit, with their text and file (``quarantined``); the returned scan leaves
    that partition out.

    The run ends when every landed file is loaded (a failure raises).  The scan
    reads with the declared schema, so columns that a later load added are there
    for all rows (NULL in the earlier ones), whatever file is listed first.
    """
    if quarantine:
        lines = stream_lines(spark, source_dir, header, recursive, max_files_per_trigger)
        if lineage:
            lines = lines.withColumns({"IngestionDate": F.current_timestamp(), "SourceFile": F.col(RAW_FILE)})
        df = parse_lines(lines, schema).withColumn(RAW_FILE, F.when(F.col(MALFORMED), F.col(RAW_FILE)))
    else:
        df = stream_files(spark, source_dir, schema, fmt, header, recursive, max_files_per_trigger, lineage)
    w = df.writeStream.format("parquet").option("path", target_path)
    if quarantine:
        w = w.partitionBy(MALFORMED)
    q = w.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    nullable = StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields])
    table = spark.read.schema(nullable).parquet(target_path)
    return table.where(~F.col(MALFORMED)).drop(MALFORMED, RAW_LINE, RAW_FILE) if quarantine else table


def quarantined(spark: SparkSession, target_path: str) -> DataFrame:
    """(RawFile, RawLine) of the malformed lines of a table loaded with ``quarantine``."""
    schema = StructType([StructField(RAW_FILE, StringType()), StructField(RAW_LINE, StringType()), StructField(MALFORMED, BooleanType())])
    return spark.read.schema(schema).parquet(target_path).where(F.col(MALFORMED)).select(RAW_FILE, RAW_LINE)
