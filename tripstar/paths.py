"""Lake layout and shared scratch locations.

Nothing here is machine-local: every location is either given by the caller (the lake root) or
read from the session's ``spark.checkpoint.dir``, which on a cluster names a shared file system.
Only when that setting is absent (local runs, tests) do we create our own directory.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class LakePaths:
    """Medallion layout under one root URI (``hdfs://...``, ``s3a://...`` or a local path)."""

    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze_rides(self) -> str:
        return self._p("bronze", "rides")

    @property
    def silver_rides(self) -> str:
        return self._p("silver", "rides")

    @property
    def silver_rides_geo(self) -> str:
        return self._p("silver", "rides_geo")

    @property
    def quarantine_rides(self) -> str:
        return self._p("quarantine", "rides")

    @property
    def zone_reference(self) -> str:
        return self._p("reference", "zone_reference")

    def gold(self, table: str) -> str:
        return self._p("gold", table)

    def table(self, path: str) -> str:
        """The name of a table of the lake: its path below the root."""
        return path.removeprefix(self.root.rstrip("/") + "/")


def checkpoint_root(spark: SparkSession) -> str:
    """The session's shared checkpoint directory.

    A configured one is taken as it is: a ``file:`` path may be a mount that all machines share. If none
    is configured, a fresh local directory is used only in local mode (tests, a single machine); on a
    cluster a machine-local folder would not survive an executor loss, so this raises instead of guessing."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared location (e.g. an hdfs:// or s3a:// path)")
        current = tempfile.mkdtemp(prefix="tripstar-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


# Scratch folders of applications that are removed when these end.
_removed_on_exit: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint directory, in a folder of the application that goes
    when the application ends."""
    sc = spark.sparkContext
    root = f"{checkpoint_root(spark)}/tripstar/{sc.applicationId}"
    if root not in _removed_on_exit:
        folder = sc._jvm.org.apache.hadoop.fs.Path(root)
        fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
        _removed_on_exit.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def written_size(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """Number and bytes of the files below ``path``; None if there is no such path."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    summary = fs.getContentSummary(at)
    return summary.getFileCount(), summary.getLength()
