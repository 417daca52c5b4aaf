"""Atomic batches in folders of files (K7, T4).

A batch of a run is written to a staging folder that readers skip, and is committed by one
entry in the commit log under ``_commits``, which lists its files.  Only then are the
files moved to their places.  So a crash leaves one of three states, and a replay of the same
batch ends all of them with one copy of its rows:

- staged, not committed: the stage is thrown away and the batch written anew;
- committed, not (all) moved: the moves are finished, nothing is written;
- moved, but the ledger row is lost: nothing is written.

``read_committed`` reads the files of committed batches only; a plain read of the folder also
sees a batch whose moves are under way in part.  Logs are kept by run and ranges of batches, so
a look-up opens a bounded number of files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from quayside.session import path_exists
from quayside.sinks.commitlog import CommitLog, HadoopFolder

STAGING, COMMITS = "_staging", "_commits"
BATCHES_PER_LOG = 1000


def log_folder(root: str, run_id: str, batch_id: int) -> str:
    return f"{root}/run={quote(run_id, safe='')}/range={batch_id // BATCHES_PER_LOG}"


class BatchCommits:
    """Commits of batches to the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _log(self, run_id: str, batch_id: int) -> CommitLog:
        return CommitLog(HadoopFolder(self.spark, log_folder(f"{self.path}/{COMMITS}", run_id, batch_id)))

    def committed(self, run_id: str, batch_id: int) -> dict | None:
        """The batch's commit: the first one, if several writers tried."""
        return next((r for r in self._log(run_id, batch_id).records() if r["batch"] == batch_id), None)

    def commit(self, run_id: str, batch_id: int, write: Callable[[str], int]) -> tuple[int, bool]:
        """(rows, whether they were written now).  ``write`` puts the batch into the folder it is given and returns its rows."""
        found = self.committed(run_id, batch_id)
        if found is not None:
            self.publish(found)
            return found["rows"], False
        stage = f"{self.path}/{STAGING}/{quote(run_id, safe='')}-{batch_id}-{uuid.uuid4().hex[:12]}"
        rows = write(stage)
        entry = {"batch": batch_id, "rows": rows, "stage": stage[len(self.path) + 1:], "files": self._files(stage)}
        self._log(run_id, batch_id).append([entry])
        winner = self.committed(run_id, batch_id)
        mine = winner["stage"] == entry["stage"]
        if not mine:                                # another writer of the same batch was first
            self._fs.delete(self._path(stage), True)
        self.publish(winner)
        return winner["rows"], mine

    def _files(self, stage: str) -> list[str]:
        """Data files below the stage, relative to it."""
        if not path_exists(self.spark, stage):
            return []
        root = self._fs.makeQualified(self._path(stage)).toString()
        out, listing = [], self._fs.listFiles(self._path(stage), True)
        while listing.hasNext():
            name = listing.next().getPath().toString()[len(root) + 1:]
            if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
                out.append(name)
        return sorted(out)

    def publish(self, entry: dict) -> None:
        """Move what is still staged; files that were moved are left alone, so that this can be repeated at any point."""
        stage = self._path(f"{self.path}/{entry['stage']}")
        if not self._fs.exists(stage):
            return
        for name in entry["files"]:
            source, target = self._path(f"{self.path}/{entry['stage']}/{name}"), self._path(f"{self.path}/{name}")
            if self._fs.exists(source):
                self._fs.mkdirs(target.getParent())
                if not self._fs.rename(source, target):
                    raise OSError(f"cannot move {source} to {target}")
        self._fs.delete(stage, True)

    def entries(self) -> list[dict]:
        """All commits, the first one of each batch."""
        out = []
        for run in self._folders(f"{self.path}/{COMMITS}"):
            for part in self._folders(run):
                seen = {}
                for r in CommitLog(HadoopFolder(self.spark, part)).records():
                    seen.setdefault(r["batch"], r)
                out += seen.values()
        return out

    def _folders(self, path: str) -> list[str]:
        root = self._path(path)
        return [s.getPath().toString() for s in self._fs.listStatus(root)] if self._fs.exists(root) else []

    def recover(self) -> int:
        """Finish the moves of all committed batches (for a query that never comes back); how many there were."""
        left = [e for e in self.entries() if self._fs.exists(self._path(f"{self.path}/{e['stage']}"))]
        for e in left:
            self.publish(e)
        return len(left)


def read_committed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The rows of committed batches; None if there are none."""
    commits = BatchCommits(spark, path)
    files = []
    for e in commits.entries():
        staged = f"{path.rstrip('/')}/{e['stage']}"
        files += [(f"{staged}/{f}" if path_exists(spark, staged) and path_exists(spark, f"{staged}/{f}") else f"{path.rstrip('/')}/{f}") for f in e["files"]]
    if not files:
        return None
    if any(f"/{STAGING}/" in f for f in files):
        commits.recover()
        return read_committed(spark, path, fmt)
    return spark.read.format(fmt).option("basePath", path).load(files)
