"""Run lineage: which algorithm ran when, on what, giving what."""

from __future__ import annotations

import datetime as dt
import hashlib
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.store import insert_if_absent
from ..schemas import TABLES
from ..sources.tables import create_tables, read_table, write_table

LINEAGE = ("algorithm", "run", "run_input", "run_output", "file", "run_input_file", "run_output_file")


def _key(table: str, *parts: Any) -> str:
    texts = [table, *["\u0000" if p is None else str(p) for p in parts]]
    return hashlib.sha256("\u0001".join(texts).encode()).hexdigest()


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class RunLog:
    """A context that adds one run to the lineage tables when it ends.

    Algorithms and files are stored once, however many runs name them.

    Values other than null are stored once, as text with their type. A failing
    run is stored too, with the exception as an output, and still raises.
    """

    def __init__(self, spark: SparkSession, root: str, algorithm: str, version: str, inputs: tuple = ()):
        self.spark, self.root = spark, root
        self.algorithm, self.version = algorithm, version
        self.inputs, self.outputs = list(inputs), []
        self.input_files: list[str] = []
        self.output_files: list[str] = []

    def add_output(self, value: Any) -> None:
        self.outputs.append(value)

    def __enter__(self) -> RunLog:
        self.begin = _now()
        return self

    def __exit__(self, kind, error, trace) -> None:
        if error is not None:
            self.outputs.append(error)
        completed = _now()
        create_tables(self.spark, self.root, LINEAGE)
        algorithm_id = _key("algorithm", self.algorithm, self.version)
        self.run_id = _key("run", algorithm_id, self.begin, completed)
        self._append("algorithm", [(algorithm_id, self.algorithm, self.version)], "algorithm_id, name, version")
        self._append("run", [(self.run_id, algorithm_id, self.begin, completed)], "run_id, algorithm_id, begin, completed")
        for table, values in (("run_input", self.inputs), ("run_output", self.outputs)):
            rows = {(type(v).__name__, str(v)) for v in values if v is not None}
            self._append(
                table,
                [(_key(table, self.run_id, *row), self.run_id, *row) for row in sorted(rows)],
                f"{table}_id, run_id, dtype, value",
            )
        for table, uris in (("run_input_file", self.input_files), ("run_output_file", self.output_files)):
            files = {_key("file", uri): uri for uri in sorted(set(uris))}
            self._append("file", list(files.items()), "file_id, uri")
            rows = [(_key(table, self.run_id, f), self.run_id, f) for f in files]
            self._append(table, rows, f"{table}_id, run_id, file_id")

    def _append(self, table: str, rows: list[tuple], columns: str) -> None:
        if rows:
            names = [c.strip() for c in columns.split(",")]
            types = ["timestamp" if c in ("begin", "completed") else "string" for c in names]
            ddl = ", ".join(f"{n} {t}" for n, t in zip(names, types))
            batch, key = self.spark.createDataFrame(rows, ddl), TABLES[table].key
            stored = read_table(self.spark, self.root, table)
            write_table(insert_if_absent(stored, batch, key, *[F.col(k) for k in key]), self.root, table)
