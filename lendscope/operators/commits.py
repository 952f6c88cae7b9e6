"""A log of numbered entries that several jobs may append to at a time: every number is taken once."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import types as T


class CommitLog:
    """Small JSON files named by number below ``base``.

    An entry is written under another name first and then renamed to its number, which fails when that exists. So of two
    jobs that want the same number one gets it, and the other learns that the table has moved on since it looked. Readers see
    an entry whole or not at all. (The rename is atomic on HDFS and on stores with conditional writes; on a local
    disk it is a check and a rename.)
    """

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType | str):
        self.spark = spark
        self.base = base.rstrip("/")
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")

    def _files(self) -> list[str]:
        path = self._path("")
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(path):
            return []
        names = [status.getPath().getName() for status in system.listStatus(path)]
        return sorted(name for name in names if name.endswith(".json") and name[0] not in "._")

    def last(self) -> int:
        """The highest number that is taken; 0 before the first."""
        return max((int(name.removesuffix(".json")) for name in self._files()), default=0)

    def entries(self) -> list[dict]:
        """All entries in order, each with its ``number``."""
        names = self._files()
        if not names:
            return []
        schema = T.StructType([T.StructField("number", T.LongType()), *self.schema.fields])
        rows = self.spark.read.schema(schema).json([f"{self.base}/{name}" for name in names]).collect()
        return [row.asDict() for row in sorted(rows, key=lambda row: row["number"])]

    def commit(self, number: int, **entry) -> bool:
        """Write the entry under ``number``; False when another job has it already."""
        conf, jvm = self.spark._jsc.hadoopConfiguration(), self.spark._jvm
        waiting, target = self._path(f".{uuid.uuid4().hex}"), self._path(f"{number:012d}.json")
        system = target.getFileSystem(conf)
        stream = system.create(waiting, False)
        try:
            stream.write(bytearray(json.dumps({"number": number, **entry}).encode() + b"\n"))
        finally:
            stream.close()
        kinds = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kinds, 1)
        options[0] = kinds.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(waiting, target, options)
        except Exception as error:
            system.delete(waiting, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True


class Conflict(RuntimeError):
    """Another job committed first: what this one has read is no longer the newest state."""
