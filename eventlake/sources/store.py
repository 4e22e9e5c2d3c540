"""Files of the lake, through Hadoop's file systems, so that the lake may lie in any store that Spark can read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or, on one machine where none is set, a temporary one.

    A cluster without one is refused: what an executor writes to its own disk the others can't read.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        at = tempfile.mkdtemp(prefix="eventlake-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(at)
        at = spark.sparkContext.getCheckpointDir()
    return at.rstrip("/")


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool
    bytes: int


class Store:
    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def list(self, path: str) -> list[Entry]:
        """What lies in a folder, by name; nothing if there is no such folder."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        found = [Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen()) for s in fs.listStatus(p)]
        return sorted(found, key=lambda e: e.name)

    def glob(self, pattern: str) -> list[str]:
        fs, p = self._at(pattern)
        return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])

    def bytes(self, path: str) -> int:
        """All files below, hidden ones apart."""
        total = 0
        for e in self.list(path):
            if not e.name.startswith((".", "_")):
                total += self.bytes(e.path) if e.is_dir else e.bytes
        return total

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def make_folder(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def move(self, source: str, target: str) -> None:
        fs, p = self._at(source)
        if not fs.rename(p, self._at(target)[1]):
            raise OSError(f"cannot move {source} to {target}")

    def staging(self, target: str) -> str:
        """A hidden place beside the target, new each time: readers pass over it, and two runs never share one."""
        parent, _, name = target.rstrip("/").rpartition("/")
        return f"{parent}/.{name}-{uuid.uuid4().hex}"

    def _replaced(self, target: str) -> list[str]:
        """Where publish() has put what stood at the target, if it didn't come to its end."""
        parent, _, name = target.rstrip("/").rpartition("/")
        return [e.path for e in self.list(parent) if e.name.startswith(f".{name}-old-")]

    def settled(self, target: str) -> str | None:
        """Where the target's content is: in its place, or set aside by a publish() that is under way or was cut off; None if nowhere."""
        if self.exists(target):
            return target
        old = self._replaced(target)
        return target if self.exists(target) else old[0] if old else None

    def recover(self, target: str) -> None:
        """Ends a publish() that was cut off: what it had set aside comes back, or goes if the new one stands. For the target's only writer."""
        for old in self._replaced(target):
            if self.exists(target):
                self.delete(old)
            else:
                self.move(old, target)

    def _replace_file(self, staged: str, target: str) -> bool:
        """Puts a staged file in another's place in one step; False for folders, and in stores that have no such step."""
        fs, p = self._at(staged)
        if not fs.getFileStatus(p).isFile():
            return False
        jvm = self._jvm
        options = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        try:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        except Py4JJavaError:  # no FileContext for this store
            return False
        context.rename(p, self._at(target)[1], options)
        return True

    def publish(self, staged: str, target: str) -> None:
        """Puts the staged folder or file in the target's place; what stood there goes only when the new one stands.

        A file takes another's place in one step. Stores have no such step for folders, so between two renames the old folder is
        hidden beside its place, where settled() finds it; after a crash there, the next run puts it back.
        """
        self.make_folder(target.rstrip("/").rpartition("/")[0])
        if self._replace_file(staged, target):
            return
        self.recover(target)
        old = None
        if self.exists(target):
            parent, _, name = target.rstrip("/").rpartition("/")
            old = f"{parent}/.{name}-old-{uuid.uuid4().hex}"
            self.move(target, old)
        try:
            self.move(staged, target)
        except Exception:
            if old:
                self.move(old, target)
            raise
        if old:
            self.delete(old)

    def write(self, path: str, data: bytes) -> None:
        """A whole file at once: staged, then put in place."""
        staged = self.staging(path)
        self.make_folder(path.rpartition("/")[0])
        fs, p = self._at(staged)
        out = fs.create(p, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
        self.publish(staged, path)

    def upload(self, local: str, path: str) -> None:
        """A local file into the store: staged, then put in place."""
        staged = self.staging(path)
        self.make_folder(path.rpartition("/")[0])
        fs, p = self._at(staged)
        fs.copyFromLocalFile(False, True, self._jvm.org.apache.hadoop.fs.Path(f"file://{local}"), p)
        self.publish(staged, path)
