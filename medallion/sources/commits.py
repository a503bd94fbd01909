"""Commit marks of snapshot stores.

A snapshot's rows are first written, as their own Spark job, into a staging folder of
the store.  The snapshot is committed by creating its mark, a small JSON file that names
the staged attempt and its row count; the mark is created exclusively, so of two
concurrent ingests one commits and the other drops what it staged.  Publishing then moves
the attempt's files into the snapshot's partition, and removes files of no committed
attempt.  Every step can be repeated by anyone: a run that finds a mark whose publishing
was cut off finishes it, and a snapshot without a mark (or with fewer rows than its mark
says) is unfinished and replaced by a new generation of the mark.

Folders beginning with an underscore are invisible to Spark's readers, so a plain read of
the store sees published rows only.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import SparkSession

MARKS, STAGING = "_commits", "_staging"
_CREATE = threading.Lock()


class SnapshotStore:
    """Marks and partitions of one store partitioned by ``snapshot_date`` and ``snapshot_season``."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self.fs = self._path(self.target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    @staticmethod
    def key(date: str, season) -> str:
        return f"snapshot_date={date}/snapshot_season={'__HIVE_DEFAULT_PARTITION__' if season is None else season}"

    def _files(self, folder: str) -> list:
        path = self._path(folder)
        return list(self.fs.listStatus(path)) if self.fs.exists(path) else []

    def _data_files(self, folder: str) -> list[str]:
        return [f.getPath().getName() for f in self._files(folder)
                if f.isFile() and not f.getPath().getName().startswith(("_", "."))]

    # -- marks ---------------------------------------------------------------
    def mark(self, key: str) -> dict | None:
        """The newest mark of a snapshot, None where it was never committed."""
        names = [f.getPath().getName() for f in self._files(f"{self.target}/{MARKS}/{key}")]
        gens = sorted(int(n.split(".")[0]) for n in names if n.endswith(".json"))
        if not gens:
            return None
        text = self._read(f"{self.target}/{MARKS}/{key}/{gens[-1]}.json")
        return {**json.loads(text), "generation": gens[-1], "published": f"{gens[-1]}.done" in names}

    def _read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, path: str, text: str) -> bool:
        """Create a file that must not exist yet; False where it does."""
        with _CREATE:   # local file systems look before they create; others are atomic themselves
            target = self._path(path)
            if self.fs.exists(target):
                return False
            self.fs.mkdirs(target.getParent())
            try:
                out = self.fs.create(target, False)
            except Exception:  # noqa: BLE001  (created by another application meanwhile)
                if self.fs.exists(target):
                    return False
                raise
            try:
                out.write(bytearray(text.encode()))
            finally:
                out.close()
            return True

    # -- commit --------------------------------------------------------------
    def staging(self) -> tuple[str, str]:
        """``(attempt, folder)`` for a new attempt's files."""
        attempt = uuid.uuid4().hex
        return attempt, f"{self.target}/{STAGING}/{attempt}"

    def drop(self, attempt: str) -> None:
        self.fs.delete(self._path(f"{self.target}/{STAGING}/{attempt}"), True)

    def commit(self, key: str, attempt: str, rows: int, after: dict | None = None) -> bool:
        """Mark the attempt as the snapshot's content, following the mark ``after`` that the run
        found when it began; False where another run committed meanwhile."""
        generation = 0 if after is None else after["generation"] + 1
        text = json.dumps({"attempt": attempt, "rows": rows})
        return self._create(f"{self.target}/{MARKS}/{key}/{generation}.json", text)

    def adopt(self, key: str, rows: int) -> None:
        """Mark a snapshot that was stored whole before there were marks."""
        if self._create(f"{self.target}/{MARKS}/{key}/0.json", json.dumps({"attempt": "", "rows": rows})):
            self._create(f"{self.target}/{MARKS}/{key}/0.done", "")

    def publish(self, key: str) -> dict | None:
        """Finish the newest commit: its files in place, others of the snapshot gone."""
        mark = self.mark(key)
        if mark is None or mark["published"]:
            return mark
        attempt, final = mark["attempt"], f"{self.target}/{key}"
        staged = f"{self.target}/{STAGING}/{attempt}"
        for name in self._data_files(final):
            if not name.startswith(attempt):
                self.fs.delete(self._path(f"{final}/{name}"), False)
        self.fs.mkdirs(self._path(final))
        for name in self._data_files(staged):   # as many as the write had tasks; a missing one was moved by another run
            self._move(f"{staged}/{name}", f"{final}/{attempt}-{name}")
        self._create(f"{self.target}/{MARKS}/{key}/{mark['generation']}.done", "")
        self.drop(attempt)
        return {**mark, "published": True}

    def _move(self, source: str, target: str) -> None:
        """Rename a file that another run may be moving to the same place."""
        try:
            moved = self.fs.rename(self._path(source), self._path(target))
        except Exception:  # noqa: BLE001  (gone between the listing and here)
            moved = False
        if not moved and not self.fs.exists(self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def committed(self) -> list[tuple[str, int | None]] | None:
        """(date, season) of every published snapshot, from the marks' names; None in a
        store without marks."""
        root = f"{self.target}/{MARKS}"
        if not self.fs.exists(self._path(root)):
            return None
        out = []
        for day in self._files(root):
            for season in self._files(day.getPath().toString()):
                names = [f.getPath().getName() for f in self._files(season.getPath().toString())]
                gens = [int(n.split(".")[0]) for n in names if n.endswith(".json")]
                if gens and f"{max(gens)}.done" in names:
                    value = season.getPath().getName().split("=", 1)[1]
                    out.append((day.getPath().getName().split("=", 1)[1], int(value) if value.lstrip("-").isdigit() else None))
        return sorted(out, key=str)
