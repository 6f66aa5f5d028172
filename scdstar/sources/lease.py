"""A lease that lets one writer at a time load a warehouse."""

from __future__ import annotations

import threading
import uuid
from types import TracebackType

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Lease:
    """A file that one writer creates and no other can while it is there.

    A held lease is renewed in the background; one that was not for ``expires`` seconds is
    taken over, as its writer must be gone. Creating without overwriting is atomic on HDFS and
    on stores with conditional writes; the file system must keep modification times.
    """

    def __init__(self, spark: SparkSession, folder: str, expires: float = 600.0) -> None:
        self.spark, self.expires, self.token = spark, expires, uuid.uuid4().hex
        self._path = self._hadoop_path(f"{folder}/_writer")
        self._files = self._path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._done = threading.Event()
        self._renewing: threading.Thread | None = None

    def _hadoop_path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _now(self) -> int:
        return self.spark._jvm.java.lang.System.currentTimeMillis()

    def _create(self) -> bool:
        try:
            out = self._files.create(self._path, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName() or self._files.exists(self._path):
                return False
            raise
        out.write(bytearray(self.token.encode()))
        out.close()
        return True

    def _age(self) -> float:
        """Seconds since the lease was last renewed."""
        return (self._now() - self._files.getFileStatus(self._path).getModificationTime()) / 1000

    def _owner(self) -> str | None:
        if not self._files.exists(self._path):
            return None
        stream = self._files.open(self._path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def held(self) -> bool:
        return self._owner() == self.token

    def __enter__(self) -> Lease:
        if not self._create():
            age = self._age()
            if age <= self.expires:
                raise RuntimeError(f"another load holds {self._path}, renewed {age:.0f} seconds ago")
            # One of several that see it expired can rename it.
            if not self._files.rename(self._path, self._hadoop_path(f"{self._path}.{self.token}")):
                raise RuntimeError(f"another load has taken over {self._path}")
            self._files.delete(self._hadoop_path(f"{self._path}.{self.token}"), False)
            if not self._create():
                raise RuntimeError(f"another load has taken over {self._path}")
        self._renewing = threading.Thread(target=self._renew, daemon=True)
        self._renewing.start()
        return self

    def _renew(self) -> None:
        while not self._done.wait(self.expires / 4):
            if self.held():
                self._files.setTimes(self._path, self._now(), -1)

    def __exit__(
        self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None
    ) -> None:
        self._done.set()
        if self._renewing:
            self._renewing.join()
        if self.held():
            self._files.delete(self._path, False)
