"""From landed files to RAW tables: every file once, bad input set aside.

A load takes the files that no earlier load took, writes their rows to a folder of its own
under the RAW table, what cannot be read to a quarantine table, and enters its files in a
ledger last. Rows count once their load is in the ledger: folders of loads that died before
that are dropped by the next one, which takes their files again. So a load that is repeated
adds nothing, and a load that was killed loses nothing.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollcall.operators import flatten
from rollcall.sources import raw
from rollcall.sources.tables import _fs, drop, exists

LINE = "_corrupt_record"
LOAD = "load"

# What may be wrong with a landed line.
BAD_LINE = "line is not JSON"
NO_TEXT = "no RAW_DATA"
BAD_ENVELOPE = "envelope is not whole JSON"
NO_ARRAY = "envelope without a data array"

# A load of documents, as the request list's ledger names it.
DOCUMENTS = "documents/"

LEDGER = "file string, bytes bigint, rows bigint, bad_rows bigint, load string, loaded_at timestamp"


def read_lines(spark: SparkSession, paths: list[str], table: str, batch_ts: dt.datetime) -> DataFrame:
    """Landed lines with the file they come from; a line that cannot be read is kept as text."""
    schema = StructType.fromDDL(f"{raw.SCHEMAS[table]}, {LINE} string")
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
    df = reader.json(paths).select("*", F.col("_metadata.file_path").alias("file"))
    stamp = "INGEST_TS" if table == "details" else "SYNC_TIME"
    return df.withColumn(stamp, raw.load_stamp(F.col(stamp), batch_ts))


def problem(text: Column, envelopes: bool) -> Column:
    """What is wrong with a line, NULL when nothing is. An empty ``data`` array is in order."""
    kind = f"data array<string>, {LINE} string" if envelopes else f"{LINE} string"
    parsed = F.from_json(text, kind, {"columnNameOfCorruptRecord": LINE})
    found = F.when(F.col(LINE).isNotNull(), BAD_LINE).when(text.isNull() | (F.trim(text) == ""), NO_TEXT)
    found = found.when(parsed.isNull() | parsed.getField(LINE).isNotNull(), BAD_ENVELOPE)
    return found.when(parsed.getField("data").isNull(), NO_ARRAY) if envelopes else found


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file, bytes`` of all files below a folder; their contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return found.select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def ledger(spark: SparkSession, root: str, table: str) -> DataFrame:
    path = f"{root}/LEDGER/{table}"
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def _drop_unlisted(spark: SparkSession, path: str, listed: set[str]) -> None:
    if exists(spark, path):
        fs, folder = _fs(spark, path)
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith(f"{LOAD}=") and name.partition("=")[2] not in listed:
                drop(spark, f"{path}/{name}")


def load_new(
    spark: SparkSession, folder: str, table: str, root: str, batch_ts: dt.datetime, envelopes: bool = True
) -> int:
    """Load the files below ``folder`` that the ledger lacks; their number.

    A file is known by path and size, so one that has grown is taken again as a whole;
    landing jobs write new files and leave old ones alone.
    """
    raw_path, bad_path = f"{root}/RAW/{table}", f"{root}/QUARANTINE/{table}"
    known = ledger(spark, root, table)
    # One row a load.
    listed = {r[0] for r in known.select(LOAD).distinct().collect()}
    for path in (raw_path, bad_path):
        _drop_unlisted(spark, path, listed)
    fresh = landed_files(spark, folder).join(known, ["file", "bytes"], "left_anti")
    # The reader below needs the names on the driver, as Spark's own listing does.
    files = {r.file: r.bytes for r in fresh.collect()}
    if not files:
        return 0
    load = uuid.uuid4().hex
    lines = read_lines(spark, sorted(files), table, batch_ts).withColumn("problem", problem(F.col("RAW_DATA"), envelopes))
    split = f"{root}/STAGED/{table}/{LOAD}={load}"
    lines.withColumn("bad", F.col("problem").isNotNull()).write.partitionBy("bad").parquet(split)
    staged = spark.read.schema(lines.withColumn("bad", F.lit(True)).schema).parquet(split)
    staged.filter(~F.col("bad")).drop("bad", "problem", LINE).write.parquet(f"{raw_path}/{LOAD}={load}")
    staged.filter("bad").select("file", "problem", F.coalesce(LINE, "RAW_DATA").alias("text")).write.parquet(
        f"{bad_path}/{LOAD}={load}"
    )
    counts = staged.groupBy("file").agg(F.count_if(~F.col("bad")).alias("rows"), F.count_if("bad").alias("bad_rows"))
    sizes = spark.createDataFrame(sorted(files.items()), "file string, bytes bigint")
    # Files of blank lines are entered too.
    entries = sizes.join(counts, "file", "left").fillna(0, ["rows", "bad_rows"])
    entries = entries.withColumns({LOAD: F.lit(load), "loaded_at": F.lit(batch_ts).cast("timestamp")})
    names = [f.name for f in StructType.fromDDL(LEDGER)]
    entries.select(*names).coalesce(1).write.mode("append").parquet(f"{root}/LEDGER/{table}")
    drop(spark, split)
    return len(files)


def list_documents(spark: SparkSession, root: str, batch_ts: dt.datetime, size: int = 500) -> int:
    """Append the documents of new ``details`` loads to the request list, in envelopes; the number of loads taken.

    Without this the list would show a request as pending until its page is pulled again.
    A document counts when its ``data`` is an object. Each load is entered in the list's
    ledger under its name, last, so it is taken once, also after a run that died.
    """
    names = F.concat(F.lit(DOCUMENTS), F.col(LOAD))
    listed = {r[0] for r in ledger(spark, root, "approvals").select("file").filter(F.col("file").startswith(DOCUMENTS)).collect()}
    # One row a load.
    loads = sorted({r[0] for r in ledger(spark, root, "details").select(names).distinct().collect()} - listed)
    if not loads:
        return 0
    load = uuid.uuid4().hex
    documents = read_raw(spark, root, "details").filter(names.isin(loads))
    record = F.get_json_object("RAW_DATA", "$.data")
    records = documents.select(F.when(F.ltrim(record).startswith("{"), record).alias("rec"))
    rows = flatten.pack_envelopes(records, size).select(F.lit(batch_ts).cast("timestamp").alias("SYNC_TIME"), "RAW_DATA")
    path = f"{root}/RAW/approvals/{LOAD}={load}"
    rows.withColumn("file", F.lit(DOCUMENTS)).write.parquet(path)
    entries = [(name, 0, None, 0, load, batch_ts) for name in loads]
    spark.createDataFrame(entries, LEDGER).coalesce(1).write.mode("append").parquet(f"{root}/LEDGER/approvals")
    return len(loads)


def read_raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The RAW table, each row with its file and load."""
    schema = f"{raw.SCHEMAS[table]}, file string, {LOAD} string"
    path = f"{root}/RAW/{table}"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_quarantine(spark: SparkSession, root: str, table: str) -> DataFrame:
    schema = f"file string, problem string, text string, {LOAD} string"
    path = f"{root}/QUARANTINE/{table}"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
