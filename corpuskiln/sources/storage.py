"""A folder on the session's file system: small state files written whole, tables as parquet folders, unused ones removed."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Folder:
    """``root`` is a URI, or a path on the session's default file system.

    A path on the machine's own disk is only accepted where the master runs in one process, or below the shared folder that the
    cluster names in ``spark.checkpoint.dir`` (a mount that all executors have).
    """

    def __init__(self, spark: SparkSession, root: str):
        jvm, self.spark = spark._jvm, spark
        path = jvm.org.apache.hadoop.fs.Path(root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.uri = self._fs.makeQualified(path).toString().rstrip("/")
        master = spark.sparkContext.master
        if self.uri.startswith("file:") and master != "local" and not master.startswith("local["):
            shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
            if not shared or not self.uri.startswith(self._fs.makeQualified(jvm.org.apache.hadoop.fs.Path(shared)).toString().rstrip("/") + "/"):
                raise ValueError(f"{root} lies on one machine; name a folder that all executors share")
        self._fs.mkdirs(jvm.org.apache.hadoop.fs.Path(self.uri))

    def path(self, name: str) -> str:
        return f"{self.uri}/{name}"

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Names in a folder below the root, in order; none if there is no such folder."""
        at = self._at(name) if name else self.spark._jvm.org.apache.hadoop.fs.Path(self.uri)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def read_json(self, name: str):
        """The parsed file, or None if there is none."""
        if not self.exists(name):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write_json(self, name: str, value) -> None:
        """Written beside and renamed over the old file, so readers see one or the other."""
        part = f".{name}-{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(part), True)
        try:
            stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        finally:
            stream.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at(name).toUri(), self.spark._jsc.hadoopConfiguration()).rename(self._at(part), self._at(name), how)

    def write_table(self, df: DataFrame, kind: str) -> str:
        """Write a new folder of this kind and return its name."""
        name = f"{kind}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(self.path(name))
        return name

    def read_tables(self, names: list[str], schema: str) -> DataFrame:
        """The rows of all named folders; an empty frame for none."""
        return self.spark.read.schema(schema).parquet(*map(self.path, names)) if names else self.spark.createDataFrame([], schema)

    def keep_only(self, kinds: tuple[str, ...], used: set[str]) -> None:
        """Delete the tables of these kinds that are not among the used ones."""
        for name in self.names():
            if name.rpartition("-")[0] in kinds and name not in used:
                self.delete(name)
