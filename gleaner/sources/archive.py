"""Archives of many files, some of which may be broken or gone: a source that
fails is set aside with its reason, the others are read."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner import schemas
from gleaner.session import materialize

PIECE = 1 << 20
_FINDING = "file string, fault string"


def _gzip_faults(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams that end before their end mark, or whose bytes are no gzip
    stream or fail its checksum.  Inflated a piece at a time, nothing is kept."""
    for rows in batches:
        found = []
        for file, content in zip(rows.column("file").to_pylist(), rows.column("content")):
            bytes_, fault = memoryview(content.as_buffer()), None
            try:
                stream = zlib.decompressobj(31)
                for a in range(0, len(bytes_), PIECE):
                    piece = bytes(bytes_[a:a + PIECE])
                    while piece:
                        if stream.eof:          # another member follows
                            stream = zlib.decompressobj(31)
                        stream.decompress(piece, PIECE)
                        while stream.unconsumed_tail:
                            stream.decompress(stream.unconsumed_tail, PIECE)
                        piece = stream.unused_data
                if not stream.eof:
                    fault = "truncated"
            except zlib.error:
                fault = "corrupt"
            found.append((file, fault))
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found], pa.string()), pa.array([x for _, x in found], pa.string())],
                                         names=["file", "fault"])


def _below(root: str, file: Column) -> Column:
    """The path of a file below the folder."""
    folder = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", root).rstrip("/") + "/"
    return F.substr(file, F.instr(file, folder) + len(folder))


def broken_files(spark: SparkSession, root: str, rows: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """(file, reason) of the files under ``root`` that cannot be used whole.

    The listing (one row a file, its bytes unread) is reconciled with what was
    read: ``rows`` has a ``file`` column, the path of each row's file.
    ``missing``: a path of ``expected`` (column ``name``, below ``root``) that is
    not listed or has no bytes (Spark lists neither);
    ``truncated`` or ``corrupt``: a .gz file whose stream does not end or does
    not inflate (one task inflates such a file whole to read it, and does so
    here once more); ``unreadable``: any other file with bytes but no rows."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(
        F.col("_metadata.file_path").alias("file"), _below(root, F.col("_metadata.file_path")).alias("name"), "length", "content")
    files = listed.select("file", "name", "length")
    faults = (listed.where(F.endswith("name", F.lit(".gz"))).select("file", "content").mapInArrow(_gzip_faults, _FINDING)
              .where("fault is not null"))
    empty = files.where("length > 0").join(rows.select("file").distinct(), "file", "left_anti")
    reasons = (files.join(faults, "file", "left").join(empty.select("file", F.lit("unreadable").alias("empty")), "file", "left")
               .select("file", F.coalesce("fault", "empty").alias("reason")).where("reason is not null"))
    if expected is None:
        return reasons
    gone = expected.select("name").distinct().join(files.select("name"), "name", "left_anti")
    return reasons.unionByName(gone.select(F.col("name").alias("file"), F.lit("missing").alias("reason")))


def read_threads_isolated(spark: SparkSession, root: str, expected: DataFrame | None = None,
                          fmt: str = "json") -> tuple[DataFrame, DataFrame]:
    """SRC-1 over an archive of files of which some fail: (threads, broken).

    Rows of files that are not whole are set aside with their file, as a
    source that fails gives nothing; all others are there (malformed lines in
    ``_corrupt_record``, see ``threads.split_malformed``).  ``broken`` is
    written once: (file, reason), see ``broken_files``."""
    schema = schemas.THREAD if fmt != "json" else T.StructType(schemas.THREAD.fields + [T.StructField("_corrupt_record", T.StringType())])
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true") \
        .option("recursiveFileLookup", "true")
    if fmt == "json":
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    rows = reader.format(fmt).load(root).withColumn("file", F.col("_metadata.file_path"))
    broken = materialize(broken_files(spark, root, rows, expected), "broken-files")
    return rows.join(broken.select("file"), "file", "left_anti").drop("file"), broken
