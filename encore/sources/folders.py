"""Tables filled batch by batch, compacted behind a manifest.

A stream writes each micro-batch into folders of its own (``dt=D/batch_id=B``,
or ``batch=B`` without days), so a replayed batch replaces its own rows. After
many batches a day is many small folders. ``compact`` rewrites what batches up
to a given one wrote, one folder a day, under a name that readers of the
plain path do not see, and then publishes a manifest: which folder holds each day, and
up to which batch it does. ``read`` takes the newest manifest's folders and the batch
folders after it, so a reader sees the table before or after a compaction, never between.

A manifest is created only if its number is free, so of two compactions at
once one wins and the other's folder is dropped. A batch up to the manifest's that is replayed
writes its folder again, which readers no longer look at. ``vacuum`` deletes what the newest
manifest does not need; call it when readers of the older one are done.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS, COMPACTED = "_manifests", "_compacted"
#: Fixed value: Spark's folder name of a null partition value.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, hpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def delete(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.delete(hpath, True))


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, old = _fs(spark, source)
    if not fs.rename(old, _fs(spark, target)[1]):
        raise OSError(f"cannot move {source} to {target}")


def create_if_absent(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a small file with all its text at once; False if there is one already.

    The text is written under another name first. A local file is then linked,
    elsewhere renamed: both fail if the name is taken (HDFS; object stores need one whose rename does).
    """
    path = path.rstrip("/")
    folder, name = path.rsplit("/", 1)
    fs, target = _fs(spark, path)
    _, spare = _fs(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(spare, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            try:
                os.link(spare.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        return not fs.exists(target) and bool(fs.rename(spare, target))
    finally:
        fs.delete(spare, False)


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _fs(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass(frozen=True)
class Manifest:
    """``folders``: the compacted folder of each day ("" without days), all of
    batches up to ``upto``."""

    number: int = 0
    upto: int = -1
    folders: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class BatchTable:
    """The table at ``path``: folders of batches (column ``batch``), below
    those of days (column ``day``) unless that is None."""

    spark: SparkSession
    path: str
    batch: str = "batch_id"
    day: str | None = "dt"

    def manifest(self) -> Manifest:
        names = [n for n in child_names(self.spark, f"{self.path}/{MANIFESTS}") if n.isdigit()]
        if not names:
            return Manifest()
        newest = max(names, key=int)
        return Manifest(int(newest), **json.loads(read_text(self.spark, f"{self.path}/{MANIFESTS}/{newest}")))

    def exists(self) -> bool:
        return bool(self._raw_folders()) or bool(self.manifest().folders)

    def _raw_folders(self) -> list[str]:
        return [n for n in child_names(self.spark, self.path) if n.startswith(f"{self.day or self.batch}=")]

    def _raw(self, after: int) -> DataFrame | None:
        """Rows of the batch folders after batch ``after``."""
        if not self._raw_folders():
            return None
        return self.spark.read.parquet(self.path).where(F.col(self.batch) > after)

    def _compacted(self, folders: dict[str, str]) -> DataFrame | None:
        if not folders:
            return None
        base = f"{self.path}/{COMPACTED}"
        paths = [f"{base}/{f}" for f in sorted(folders.values())]
        return self.spark.read.option("basePath", base).parquet(*paths).drop("g")

    @staticmethod
    def _together(*parts: DataFrame | None) -> DataFrame | None:
        there = [p for p in parts if p is not None]
        if len(there) < 2:
            return there[0] if there else None
        first, second = there
        return first.unionByName(second.select(*[F.col(c).cast(first.schema[c].dataType) for c in first.columns]))

    def read(self, upto: int | None = None) -> DataFrame | None:
        """All rows, or those of batches up to ``upto``; None if nothing was written yet."""
        m = self.manifest()
        rows = self._together(self._compacted(m.folders), self._raw(m.upto))
        if rows is None or upto is None:
            return rows
        return rows.where(F.col(self.batch) <= upto)

    def compact(self, upto: int) -> Manifest | None:
        """Rewrite what batches up to ``upto`` (all committed: none of them may be the
        one that is replayed) added since the last compaction, with the days'
        earlier rows. The new manifest; None if nothing changed or another compaction won.
        """
        old = self.manifest()
        raw = self._raw(old.upto)
        raw = raw.where(F.col(self.batch) <= upto) if raw is not None else None
        if raw is None or upto <= old.upto or raw.isEmpty():
            return None
        folder = f"g={old.number + 1}-{uuid.uuid4().hex[:8]}"
        if self.day is None:
            rows, days = self._together(self._compacted(old.folders), raw), [""]
            writer = rows.hint("rebalance").write
        else:
            # names of folders: as many as the batches touched days
            named = F.coalesce(F.col(self.day).cast("string"), F.lit(NO_DAY))
            days = sorted(r[0] for r in raw.select(named).distinct().collect())
            touched = {d: f for d, f in old.folders.items() if d in set(days)}
            rows = self._together(self._compacted(touched), raw)
            writer = rows.hint("rebalance", self.day).write.partitionBy(self.day)
        writer.mode("overwrite").parquet(f"{self.path}/{COMPACTED}/{folder}")
        folders = old.folders | {d: f"{folder}/{self.day}={d}" if d else folder for d in days}
        text = json.dumps({"upto": upto, "folders": folders})
        if not create_if_absent(self.spark, f"{self.path}/{MANIFESTS}/{old.number + 1}", text):
            delete(self.spark, f"{self.path}/{COMPACTED}/{folder}")
            return None
        return Manifest(old.number + 1, upto, folders)

    def vacuum(self) -> int:
        """Delete batch folders and compacted folders that the newest manifest does not need; how many."""
        m, gone = self.manifest(), []
        if not m.number:
            return 0
        for name in self._raw_folders():
            if self.day is None:
                gone += [f"{self.path}/{name}"] * (int(name.split("=", 1)[1]) <= m.upto)
                continue
            batches = [b for b in child_names(self.spark, f"{self.path}/{name}") if b.startswith(f"{self.batch}=")]
            old = [b for b in batches if int(b.split("=", 1)[1]) <= m.upto]
            gone += [f"{self.path}/{name}"] if len(old) == len(batches) else [f"{self.path}/{name}/{b}" for b in old]
        used = {f.split("/", 1)[0] for f in m.folders.values()}
        gone += [f"{self.path}/{COMPACTED}/{n}" for n in child_names(self.spark, f"{self.path}/{COMPACTED}") if n.startswith("g=") and n not in used]
        for path in gone:
            delete(self.spark, path)
        return len(gone)

