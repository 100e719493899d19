"""Files as such, in any store that Spark reads: Spark's own file system interface moves them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Moves are calls to the store, so many wait at once.
THREADS = 16


class Files:
    """The file system of a folder; names are plain (not URL-encoded) paths below it."""

    def __init__(self, spark: SparkSession, root: str):
        # Looked up once: each part of a class's name is a call to the JVM, and there are two paths for each move.
        self._class = spark._jvm.org.apache.hadoop.fs.Path
        self._root = root.rstrip("/")
        self._made: set[str] = set()
        self._system = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._class(f"{self._root}/{name}")

    def exists(self, name: str) -> bool:
        return self._system.exists(self._path(name))

    def folders(self, name: str) -> list[str]:
        """Names of the folders directly below a folder; none if it is not there."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._system.listStatus(self._path(name)) if s.isDirectory())

    def delete(self, name: str) -> None:
        self._system.delete(self._path(name), True)

    def set_modified(self, name: str, milliseconds: int) -> None:
        self._system.setTimes(self._path(name), milliseconds, -1)

    def set_all_modified(self, names: Iterable[str], milliseconds: int) -> None:
        self._all(self.set_modified, ((name, milliseconds) for name in names))

    def move(self, source: str, target: str) -> None:
        """Move a file, replacing the target. A source that is gone was moved by an earlier try."""
        here, there = self._path(source), self._path(target)
        if not self._system.exists(here):
            return
        folder = target.rpartition("/")[0]
        if folder not in self._made:
            self._system.mkdirs(there.getParent())
            self._made.add(folder)
        if self._system.exists(there):
            self._system.delete(there, False)
        if not self._system.rename(here, there):
            raise OSError(f"cannot move {source} to {target}")

    def move_all(self, pairs: Iterable[tuple[str, str]]) -> None:
        """Move many files; pairs are taken from the iterator a few at a time."""
        self._all(self.move, pairs)

    def _all(self, call: Callable, arguments: Iterable[tuple]) -> None:
        with ThreadPoolExecutor(THREADS) as pool:
            waiting = []
            for given in arguments:
                waiting.append(pool.submit(call, *given))
                if len(waiting) >= 64 * THREADS:
                    for done in waiting:
                        done.result()
                    waiting = []
            for done in waiting:
                done.result()
