"""The few file-system calls that the sinks need, on whatever storage a path names."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def size(self, path: str) -> int:
        """Bytes of all files below."""
        return self._fs.getContentSummary(self._path(path)).getLength()

    def write_text(self, path: str, text: str) -> None:
        """Complete or not at all: written aside and renamed."""
        aside = f"{path}.{uuid.uuid4().hex}"
        self._write(aside, text, True)
        if not self._fs.rename(self._path(aside), self._path(path)):
            self._fs.delete(self._path(aside), False)

    def create_text(self, path: str, text: str) -> bool:
        """Whether this call made the file; False, and nothing written, if there is one."""
        try:
            self._write(path, text, False)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            return False
        return True

    def _write(self, path: str, text: str, overwrite: bool) -> None:
        out = self._fs.create(self._path(path), overwrite)
        out.write(bytearray(text.encode()))
        out.close()

    def read_text(self, path: str, patience: float = 0.0) -> str:
        """The file's text; one that is still empty, as its writer is at work, is read again for
        ``patience`` seconds."""
        until = time.monotonic() + patience
        while True:
            stream = self._fs.open(self._path(path))
            try:
                text = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
            if text or time.monotonic() >= until:
                return text
            time.sleep(0.05)

    def read_if_there(self, path: str) -> str | None:
        """The file's text; None if it is gone, as another writer's sweep may have removed it."""
        try:
            return self.read_text(path)
        except Py4JJavaError as error:
            if "FileNotFoundException" not in error.java_exception.getClass().getName():
                raise
            return None

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
