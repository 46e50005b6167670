"""Tables whose versions stand behind a pointer.

A table is a folder with ``data/<version>`` folders and one small manifest file per
published version, numbered, that names its data folder. The greatest manifest is the
pointer. Publishing is: write the data, then create the next manifest, which either
exists or does not; nothing that a reader may hold is renamed or deleted. Two writers
cannot take the same number, since a manifest is never overwritten.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rollcall.sources.tables import FILE_ROWS, _fs, drop, exists

KEEP = 3  # versions that stay readable behind the current one


def _names(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    fs, folder = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder))


def _manifests(spark: SparkSession, path: str) -> list[str]:
    return [n for n in _names(spark, f"{path}/manifest") if n.isdigit()]


def _read_manifest(spark: SparkSession, path: str, number: str) -> str:
    fs, file = _fs(spark, f"{path}/manifest/{number}")
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, version: str) -> int:
    last = int((_manifests(spark, path) or ["0"])[-1])
    fs, file = _fs(spark, f"{path}/manifest/{last + 1:012d}")
    stream = fs.create(file, False)  # fails when another writer has taken the number
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    return last + 1


def stage(df: DataFrame, path: str, *partition: str) -> str:
    """Write a version's data without publishing it; its name."""
    version = uuid.uuid4().hex
    df.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(*partition).parquet(f"{path}/data/{version}")
    return version


def publish(df: DataFrame, path: str, *partition: str) -> int:
    """Write the whole table as a new version and point to it; ``df`` may read the table itself."""
    return _commit(df.sparkSession, path, stage(df, path, *partition))


def versions(spark: SparkSession, path: str) -> dict[int, str]:
    """Data folder by version number, oldest first."""
    return {int(n): f"{path}/data/{_read_manifest(spark, path, n)}" for n in _manifests(spark, path)}


def current(spark: SparkSession, path: str) -> str:
    """Data folder of the current version."""
    return f"{path}/data/{_read_manifest(spark, path, _manifests(spark, path)[-1])}"


def read(spark: SparkSession, path: str, schema: StructType | None = None, version: int | None = None) -> DataFrame:
    """The current version of a table, or a numbered one."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no version of {path} has been published")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(known[max(known) if version is None else version])


def publish_if_equal(spark: SparkSession, path: str, staged: str) -> bool:
    """Publish staged data if it has as many rows as the current version, else drop it."""
    if read(spark, path).count() != spark.read.parquet(f"{path}/data/{staged}").count():
        drop(spark, f"{path}/data/{staged}")
        return False
    _commit(spark, path, staged)
    return True


def verified_rewrite(spark: SparkSession, path: str) -> bool:
    """Rewrite the current version as a new one; keep the old one when their counts differ."""
    return publish_if_equal(spark, path, stage(read(spark, path), path))


def _complete(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder}/_SUCCESS")


def recover(spark: SparkSession, path: str) -> str:
    """Clear up after an interrupted rewrite: ``clean``, ``dropped`` or ``restored``.

    A manifest without complete data goes, which makes the version before current
    again (``restored``). Data that no manifest names are what a killed write left
    (``dropped``). Don't run it while another writer is at work on the table.
    """
    said = "clean"
    known = versions(spark, path)
    for number in sorted(known, reverse=True):
        if _complete(spark, known[number]):
            break
        drop(spark, f"{path}/manifest/{number:012d}")
        drop(spark, known.pop(number))
        said = "restored"
    named = {folder.rpartition("/")[2] for folder in known.values()}
    for name in _names(spark, f"{path}/data"):
        if name not in named:
            drop(spark, f"{path}/data/{name}")
            said = "dropped" if said == "clean" else said
    return said


def expire(spark: SparkSession, path: str, keep: int = KEEP) -> list[int]:
    """Drop all but the current version and ``keep`` before it; the numbers dropped."""
    known = versions(spark, path)
    old = sorted(known)[: -(keep + 1)]
    for number in old:
        # The manifest goes first: a reader never finds a name without its data.
        drop(spark, f"{path}/manifest/{number:012d}")
        drop(spark, known[number])
    return old
