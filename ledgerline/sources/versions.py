"""Numbered versions of a layer, and tables stored in slices that versions share.

A layer's versions are manifests ``_versions/<number>.json``, written once and
never changed. A manifest is published by creating the file of the next number,
which fails if it is there already; the publisher then takes the number after.
So versions are ordered by the file system, not by clocks, two publishers
never share a number, and a reader sees a manifest whole or not at all. On
HDFS that is a rename, which is atomic and refuses an existing target, on local
disks a hard link; an object store needs a file system with conditional writes.

A sliced table (by month, by arrival day) is stored as
``<root>/<column>=<value>/version=<v>/``. A manifest names the version of each
slice, so a new version of the table writes only the slices that changed and
refers to the others.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from ledgerline.session import CODEC

_MANIFEST = re.compile(r"(\d{10})\.json")
VERSION_COLUMN = "version"
#: The folder of rows whose slice value is null.
NULL_SLICE = "__HIVE_DEFAULT_PARTITION__"


class VersionLog:
    """The published versions of one layer. Manifests are JSON objects."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.root = root
        self.folder = f"{root}/_versions"
        self._fs = self._path(self.folder).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def numbers(self) -> list[int]:
        """Numbers of the published versions, ascending."""
        folder = self._path(self.folder)
        if not self._fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return sorted(int(m.group(1)) for m in map(_MANIFEST.fullmatch, names) if m)

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self.folder}/{number:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> dict | None:
        """The newest manifest, or ``None`` before the first."""
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def publish(self, manifest: Mapping) -> int:
        """Make a manifest the newest version; its number."""
        draft = self._path(f"{self.folder}/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        finally:
            out.close()
        number = (self.numbers() or [0])[-1] + 1
        while not self._put_if_absent(draft, f"{self.folder}/{number:010d}.json"):
            number += 1
        return number

    # ---- leases and removal (:mod:`ledgerline.sources.expiry`)

    @contextmanager
    def holding(self, run: str | None = None, number: int | None = None) -> Iterator[dict | None]:
        """Keep the newest (or a given) version from expiring, and the folders of ``run``; yields its manifest.

        ``None`` is yielded before the first version. A version that is gone
        raises FileNotFoundError.
        """
        wanted, given = number, []
        try:
            while True:
                number = wanted if wanted is not None else (self.numbers() or [None])[-1]
                manifest = self._read_if_present(number)
                given.append(self._lease({"run": run, "number": number, "manifest": manifest}))
                if number is None or self._read_if_present(number) is not None:  # still there, with the lease in place
                    break
                if wanted is not None:
                    raise FileNotFoundError(f"version {number} of {self.root} has expired")
            yield manifest
        finally:
            for lease in given:
                self._fs.delete(lease, False)

    def _lease(self, content: dict):
        """Write a lease; it appears under its name when it is complete."""
        name = f"{uuid.uuid4().hex}.json"
        draft, lease = (self._path(f"{self.root}/_leases/{prefix}{name}") for prefix in (".", ""))
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        if not self._fs.rename(draft, lease):
            raise OSError(f"could not write {lease.toString()}")
        return lease

    def _read_if_present(self, number: int | None) -> dict | None:
        if number is None or not self._fs.exists(self._path(f"{self.folder}/{number:010d}.json")):
            return None
        return self.read(number)

    def leases(self, hours: float) -> list[dict]:
        """Leases taken within the last ``hours``; older ones are deleted."""
        folder, out = self._path(f"{self.root}/_leases"), []
        for status in self._fs.listStatus(folder) if self._fs.exists(folder) else []:
            if status.getPath().getName().startswith("."):
                continue
            if status.getModificationTime() < (time.time() - hours * 3600) * 1000:
                self._fs.delete(status.getPath(), False)
                continue
            try:
                stream = self._fs.open(status.getPath())
            except Py4JJavaError:  # given back meanwhile
                continue
            try:
                text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            out.append(json.loads(text))
        return out

    def remove(self, numbers: list[int]) -> None:
        """Delete manifests; the newest is never among them."""
        for number in numbers:
            self._fs.delete(self._path(f"{self.folder}/{number:010d}.json"), False)

    def folders(self, pattern: str) -> list[str]:
        """Folders under the layer's root that fit a glob, relative to it."""
        prefix = self._path(self.root).toUri().getPath() + "/"
        found = self._fs.globStatus(self._path(f"{self.root}/{pattern}")) or []
        return sorted(s.getPath().toUri().getPath().removeprefix(prefix) for s in found)

    def delete_folder(self, folder: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{folder}"), True)

    def _put_if_absent(self, draft, target: str) -> bool:
        """Give a complete file its name, unless a file of that name exists: in one step, whoever else tries."""
        if self._fs.getScheme() == "file":  # a rename of local files replaces; a hard link does not
            source, link = (self._path(str(p)).toUri().getPath() for p in (draft, target))
            try:
                os.link(source, link)
            except FileExistsError:
                return False
            os.unlink(source)
            return True
        fs = self._jvm.org.apache.hadoop.fs
        files = fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        no_overwrite = self._gateway.new_array(fs.Options.Rename, 1)
        no_overwrite[0] = fs.Options.Rename.NONE
        try:
            files.rename(self._fs.makeQualified(draft), self._fs.makeQualified(self._path(target)), no_overwrite)
        except Py4JJavaError as exc:
            if exc.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True


# ---- sliced tables -------------------------------------------------------------------


def write_slices(df: DataFrame, root: str, column: str, version: str) -> None:
    """Write the slices of ``df`` (by its column ``column``) as ``version``; other versions are untouched."""
    out = df.withColumn(VERSION_COLUMN, F.lit(version)).write.mode("append").option("compression", CODEC)
    out.partitionBy(column, VERSION_COLUMN).parquet(root)


def written_slices(spark: SparkSession, root: str, column: str, version: str) -> list[str]:
    """Values of the slices that a version wrote, read from the folders' names."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/{column}=*/{VERSION_COLUMN}={version}")
    found = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(pattern) or []
    return sorted(s.getPath().getParent().getName().split("=", 1)[1] for s in found)


def read_slices(
    spark: SparkSession, root: str, column: str, column_type: DataType, slices: Mapping[str, str], schema: StructType
) -> DataFrame:
    """The named version of each slice, as one scan with ``column`` as its partition column, last.

    A filter on ``column`` prunes whole slices. No slice: an empty table.
    """
    full = StructType([f for f in schema if f.name != column] + [StructField(column, column_type, True)])
    if not slices:
        return spark.createDataFrame([], full)
    paths = [f"{root}/{column}={value}/{VERSION_COLUMN}={version}" for value, version in sorted(slices.items())]
    stored = StructType([*full.fields, StructField(VERSION_COLUMN, StringType(), True)])
    return spark.read.schema(stored).option("basePath", root).parquet(*paths).drop(VERSION_COLUMN)
