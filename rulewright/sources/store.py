"""A store of rule records that grows by batches.

Records lie in files by the hash bucket of their key.  What the store holds is
what its newest manifest lists: a batch first writes its files and then, in one
step, the manifest that names them, so a job that dies in between leaves
nothing behind that a reader sees, and a batch that is sent again changes
nothing.  An append reads the keys of the buckets that it adds to and of no
others.  Manifests and the buckets of a batch are small; records never pass
through the driver.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import new_records


class Conflict(RuntimeError):
    """Another writer has committed in the meantime; nothing of this batch is visible."""


@dataclass(frozen=True)
class Written:
    """What a batch did: records written, buckets added to, and files whose keys were read for it."""

    version: int
    records: int
    buckets: int
    files_read: int
    repeated: bool = False


class RuleStore:
    """The store in the folder `path`, on any file system that Spark writes to.

    `buckets` counts for a new store; an old one keeps its own.  Records with a
    null key make up a bucket's key like any other.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "rule_id", buckets: int = 64) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.buckets = self._manifest()["buckets"] or buckets

    # -- files ------------------------------------------------------------------------------------------------

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), at

    def _versions(self) -> list[int]:
        fs, at = self._fs(f"{self.path}/manifests")
        return sorted(int(f.getPath().getName().split(".")[0]) for f in fs.listStatus(at) if f.getPath().getName().endswith(".json")) if fs.exists(at) else []

    def _manifest(self, version: int | None = None) -> dict:
        """{version, buckets, batches, files: {bucket: [paths]}}; of an empty store version 0."""
        known = self._versions()
        if version is None:
            version = known[-1] if known else 0
        if version == 0:
            return {"version": 0, "buckets": 0, "batches": [], "files": {}, "ddl": None}
        if version not in known:
            raise ValueError(f"no version {version}; there are {known}")
        fs, at = self._fs(f"{self.path}/manifests/{version:010d}.json")
        with_stream = fs.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(with_stream, "UTF-8"))
        finally:
            with_stream.close()

    def _commit(self, manifest: dict) -> None:
        """Makes a manifest visible as a whole, or fails if its version is there already."""
        fs, made = self._fs(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        _, at = self._fs(f"{self.path}/manifests/{manifest['version']:010d}.json")
        out = fs.create(made, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if fs.exists(at) or not fs.rename(made, at):
            fs.delete(made, False)
            raise Conflict(f"version {manifest['version']} of {self.path} is there already")

    # -- reading ----------------------------------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame | None:
        """The records of a version (the newest), or None for an empty store."""
        manifest = self._manifest(version)
        files = [f"{self.path}/{f}" for fs in manifest["files"].values() for f in fs]
        if not manifest["ddl"]:
            return None
        schema = self.spark.createDataFrame([], manifest["ddl"]).schema
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    @property
    def version(self) -> int:
        return self._manifest()["version"]

    # -- writing ----------------------------------------------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def append(self, records: DataFrame, batch: str, *order: Column | str) -> Written:
        """Adds the records whose key isn't stored, of each key the first in `order`; members named ``_…`` are left out.

        A `batch` that the store has is not written again.
        """
        manifest = self._manifest()
        if batch in manifest["batches"]:
            return Written(manifest["version"], 0, 0, 0, True)
        placed = records.withColumn("_bucket", self._bucket())
        hit = {str(r[0]) for r in placed.select("_bucket").distinct().collect()}  # as many as there are buckets, at most
        old = [f"{self.path}/{f}" for b in hit for f in manifest["files"].get(b, [])]
        stored = self.spark.read.schema(records.select(self.key).schema).parquet(*old) if old else None
        return self._write(manifest, records, stored, batch, len(old), manifest["files"], *order)

    def overwrite(self, records: DataFrame, batch: str, *order: Column | str) -> Written:
        """Starts afresh with `records`, of each key the first in `order`; older versions stay readable until `vacuum`."""
        manifest = self._manifest()
        if batch in manifest["batches"]:
            return Written(manifest["version"], 0, 0, 0, True)
        return self._write(manifest | {"batches": [], "ddl": None}, records, None, batch, 0, {}, *order)

    def compact(self, batch: str, more_than: int = 8) -> Written:
        """Makes one file of each bucket that has more than `more_than`; what is stored stays the same."""
        manifest = self._manifest()
        if batch in manifest["batches"]:
            return Written(manifest["version"], 0, 0, 0, True)
        many = {b: fs for b, fs in manifest["files"].items() if len(fs) > more_than}
        if not many:
            return Written(manifest["version"], 0, 0, 0)
        old = [f"{self.path}/{f}" for fs in many.values() for f in fs]
        rows = self.spark.read.schema(self.spark.createDataFrame([], manifest["ddl"]).schema).parquet(*old)
        return self._write(manifest, rows, None, batch, len(old), {b: fs for b, fs in manifest["files"].items() if b not in many}, whole=True)

    def _write(self, manifest: dict, records: DataFrame, stored: DataFrame | None, batch: str, read: int, keep: dict, *order, whole: bool = False) -> Written:
        new = records if whole else _first_new(records, stored, self.key, *order)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema)
        if manifest["ddl"] not in (None, ddl):
            raise ValueError(f"records have {ddl}, the store {manifest['ddl']}")
        folder = f"data/{uuid.uuid4().hex}"
        # One file a bucket: rows of a bucket meet in one task, as many tasks as buckets.
        new.withColumn("_bucket", self._bucket()).repartition(self.buckets, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        files, made = {b: [*fs] for b, fs in keep.items()}, self._listed(folder)
        for b, names in made.items():
            files.setdefault(b, []).extend(names)
        n = self.spark.read.parquet(*[f"{self.path}/{f}" for fs in made.values() for f in fs]).count() if made else 0  # of the files' footers
        self._commit({"version": manifest["version"] + 1, "buckets": self.buckets, "batches": [*manifest["batches"], batch], "files": files, "ddl": ddl})
        return Written(manifest["version"] + 1, n, len(made), read)

    def _listed(self, folder: str) -> dict[str, list[str]]:
        fs, at = self._fs(f"{self.path}/{folder}")
        out = {}
        for d in fs.listStatus(at):
            name = d.getPath().getName()
            if name.startswith("_bucket="):
                parts = [f.getPath().getName() for f in fs.listStatus(d.getPath()) if f.getPath().getName().startswith("part-")]
                out[name.removeprefix("_bucket=")] = [f"{folder}/{name}/{p}" for p in sorted(parts)]
        return out

    def vacuum(self) -> int:
        """Removes the data folders that the newest version doesn't name, and older manifests; gives how many folders went.  Not beside a running writer."""
        manifest = self._manifest()
        named = {f.split("/")[1] for fs in manifest["files"].values() for f in fs}
        fs, at = self._fs(f"{self.path}/data")
        gone = [d.getPath() for d in fs.listStatus(at) if d.getPath().getName() not in named] if fs.exists(at) else []
        for path in gone:
            fs.delete(path, True)
        for version in self._versions()[:-1]:
            old, path = self._fs(f"{self.path}/manifests/{version:010d}.json")
            old.delete(path, False)
        return len(gone)


def _first_new(records: DataFrame, stored: DataFrame | None, key: str, *order) -> DataFrame:
    """`new_records`, with a null key counted as stored where the store has one."""
    if stored is None:
        return new_records(records, None, key, *order)
    mark = lambda df: df.withColumn("_none", F.col(key).isNull()).withColumn("_key", F.coalesce(F.col(key).cast("string"), F.lit("")))
    left = mark(records).join(mark(stored).select("_none", "_key").distinct(), ["_none", "_key"], "left_anti")
    return new_records(left, None, key, *order)
