"""Sinks: JSON lines, reports, counted manifests, and a two-phase commit around a directory of files."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sorted_columns(df: DataFrame) -> DataFrame:
    """Columns in alphabetical order, so JSON has its keys sorted."""
    return df.select(*sorted(df.columns))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int | None = None) -> None:
    """JSON lines with sorted keys; nulls are written. ``rows_per_file`` cuts each task's output into chunks."""
    writer = sorted_columns(df).write.mode(mode).option("ignoreNullFields", False)
    writer = writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer
    writer.json(path)


def append_records(df: DataFrame, path: str) -> None:
    write_jsonl(df, path, "append")


def write_report(df: DataFrame, path: str) -> None:
    """A report of one row as one JSON file."""
    sorted_columns(df).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_counted(df: DataFrame, path: str) -> int:
    """Parquet whose number of rows is read back and compared with an independent count of what was written."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(path)
    n = spark.read.parquet(path).count()
    expected = df.count()
    if n != expected:
        raise OSError(f"{path} holds {n} records, {expected} were to be written")
    return n


class Frozen(RuntimeError):
    """The target is frozen; nothing is written."""


class TwoPhaseWriter:
    """Journal, stage, verify, promote, verify, clean. A target that exists is not replaced silently.

    ``classify`` tells, after an interruption, what each journalled write came to; it never deletes anything.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, at: str) -> bool:
        return self._fs.exists(self._path(at))

    def put(self, at: str, content: str | bytes, tries: int = 4, wait: float = 0.2) -> None:
        """A small file, written beside its place and renamed into it, with some tries; what is read back must be the same."""
        data = content.encode() if isinstance(content, str) else content
        beside = f"{at}.{uuid.uuid4().hex}.tmp"
        for n in range(1, tries + 1):
            try:
                out = self._fs.create(self._path(beside), True)
                out.write(bytearray(data))
                out.close()
                if self._exists(at):
                    self._fs.delete(self._path(at), False)
                if not self._fs.rename(self._path(beside), self._path(at)) or self._fs.getFileStatus(self._path(at)).getLen() != len(data):
                    raise OSError(f"{at} was not written whole")
                return
            except Exception:  # noqa: BLE001 - the file system's exceptions come through the gateway
                if n == tries:
                    raise
                time.sleep(wait * n)

    def freeze(self) -> None:
        self.put(f"{self.root}/_FROZEN", "")

    def fingerprint(self, df: DataFrame) -> tuple[int, int]:
        """Rows and an order-free hash of them."""
        h = F.xxhash64(*[F.to_json(F.struct(c)) for c in df.columns])
        r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("x")).first()
        return r.n, r.x

    def stage(self, df: DataFrame, name: str) -> tuple[str, int, int]:
        """The first phase: write the rows aside and note it; the place, and the fingerprint of what stands there."""
        if self._exists(f"{self.root}/_FROZEN"):
            raise Frozen(self.root)
        stage = f"{self.root}/_staging/{name}-{uuid.uuid4().hex}"
        df.write.parquet(stage)
        n, x = self.fingerprint(self.spark.read.parquet(stage))
        self.put(f"{self.root}/_journal/{name}.json", json.dumps({"name": name, "stage": stage, "final": f"{self.root}/{name}", "rows": n, "hash": x, "state": "STAGED"}))
        return stage, n, x

    def commit(self, df: DataFrame, name: str, replace: bool = False) -> None:
        if self._exists(f"{self.root}/_FROZEN"):
            raise Frozen(self.root)
        final = f"{self.root}/{name}"
        if self._exists(final) and not replace:
            raise FileExistsError(final)
        stage, n, x = self.stage(df, name)
        journal = f"{self.root}/_journal/{name}.json"
        if replace and self._exists(final):
            self._fs.delete(self._path(final), True)
        self._fs.mkdirs(self._path(final).getParent())
        if not self._fs.rename(self._path(stage), self._path(final)):
            raise OSError(f"{stage} could not be promoted")
        if self.fingerprint(self.spark.read.parquet(final)) != (n, x):
            raise OSError(f"{final} differs from what was staged")
        self.put(journal, json.dumps({"name": name, "stage": stage, "final": final, "rows": n, "hash": x, "state": "COMMITTED"}))

    def classify(self) -> dict[str, str]:
        """name -> COMMITTED_FINAL_CLEANED, PROMOTED_UNVERIFIED, UNCOMMITTED_STAGING or AMBIGUOUS."""
        out = {}
        if not self._exists(f"{self.root}/_journal"):
            return out
        for r in self.spark.read.option("multiLine", True).json(f"{self.root}/_journal").collect():
            final, stage = self._exists(r.final), self._exists(r.stage)
            if r.state == "COMMITTED" and final and not stage:
                out[r["name"]] = "COMMITTED_FINAL_CLEANED"
            elif final and not stage:
                out[r["name"]] = "PROMOTED_UNVERIFIED"
            elif stage and not final:
                out[r["name"]] = "UNCOMMITTED_STAGING"
            else:
                out[r["name"]] = "AMBIGUOUS"
        return out
