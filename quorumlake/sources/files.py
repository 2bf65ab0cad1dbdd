"""Landed files: inventory, digests and attachment text.

Spark's file listing passes over files of no bytes, so neither inventory nor digests have them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote
from zlib import crc32

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
FOLDERS = 256


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and time of every file below `path`; contents stay unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.substring_index("path", "/", -1).alias("name"), "length", "modificationTime")


def _located(path: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(quote(f"{known}:{rest}", safe=":/@"))


def _opened(path: str) -> pa.NativeFile:
    system, inner = _located(path)
    return system.open_input_stream(inner, compression=None)


def store_files(rows: DataFrame, target: str, name: str, content: str) -> None:
    """Every row's text, ended by a newline, as a file of its own: `<target>/<folder>/<name>-<task>-<row>`.

    Tasks write their files themselves into a bounded number of folders, so
    that nothing has to be moved when the job ends. A task that runs again
    writes the same names.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _located(target)
        task, row, made = TaskContext.get().partitionId(), 0, set()
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folder = f"{root}/{crc32(str(label).encode()) % FOLDERS:02x}"
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(f"{folder}/{label}-{task}-{row}", compression=None) as stream:
                    stream.write((text or "").encode() + b"\n")
                row += 1
            yield pa.RecordBatch.from_pydict({"stored": pa.array([batch.num_rows], pa.int64())})

    rows.select(name, content).mapInArrow(store, "stored long").agg(F.sum("stored")).collect()


def block_digest(path: str) -> str:
    """SHA-256 of a file, read block by block."""
    digest = hashlib.sha256()
    with _opened(path) as stream:
        while block := stream.read(BLOCK_BYTES):
            digest.update(block)
    return digest.hexdigest()


def digests(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every file below `path`, of any size.

    A task opens its files itself and holds one block at a time; contents
    never become rows. Spark deals the files to tasks by their size.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([block_digest(p) for p in batch.column("path").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=["path", "length", "sha256"])

    return files.select("path", "length").mapInArrow(fold, "path string, length long, sha256 string")


def missing_files(source: DataFrame, target: DataFrame, name: str = "name") -> DataFrame:
    """Files of the source inventory whose name the target does not have."""
    return source.join(target.select(name), name, "left_anti")


def attachment_texts(attachments: DataFrame, extracted: DataFrame) -> DataFrame:
    """Text of each item's attachments; missing or empty contents drop out."""
    texts = extracted.where(F.length("content") > 0).select("uri", F.col("content").alias("text"))
    return attachments.join(texts, "uri").select("minutes_item_id", "uri", "text")
