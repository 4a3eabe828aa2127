"""Small files, renames and joins on whatever file system a path's scheme names, by Hadoop's interface.

Executors write rows; the driver only renames, removes, and writes texts of a few lines. Where rows are to
be one file, the parts that executors wrote stream into it through the file system's client.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def local_path(path: str) -> str | None:
    """The path on this machine, or None for other schemes."""
    parts = urlparse(path)
    return path if not parts.scheme else parts.path if parts.scheme == "file" else None


class Store:
    def __init__(self, spark: SparkSession):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.hadoop = self.jvm.org.apache.hadoop

    def _path(self, path: str):
        return self.hadoop.fs.Path(path)

    def _system(self, path: str):
        return self._path(path).getFileSystem(self.conf)

    def qualified(self, path: str) -> str:
        """The path with its scheme, without ``..``; on this machine links are followed."""
        own = local_path(path)
        own = f"file://{os.path.realpath(own)}" if own is not None else path
        return self._system(own).makeQualified(self._path(own)).toString().rstrip("/")

    def exists(self, path: str) -> bool:
        return self._system(path).exists(self._path(path))

    def is_folder(self, path: str) -> bool:
        return self._system(path).getFileStatus(self._path(path)).isDirectory()

    def make(self, folder: str) -> None:
        self._system(folder).mkdirs(self._path(folder))

    def delete(self, path: str) -> None:
        self._system(path).delete(self._path(path), True)

    def names(self, folder: str) -> list[str]:
        return sorted(x.getPath().getName() for x in self._system(folder).listStatus(self._path(folder)))

    def rename(self, source: str, target: str, overwrite: bool = False) -> None:
        """One step of the file system; FileExistsError if the target is there and may not be replaced."""
        option = self.hadoop.fs.Options.Rename
        options = self.gateway.new_array(option, 1)
        options[0] = option.OVERWRITE if overwrite else option.NONE
        # a path's URI picks the file system, as it does everywhere else here
        context = self.hadoop.fs.FileContext.getFileContext(self._system(target).getUri(), self.conf)
        try:
            context.rename(self._path(source), self._path(target), options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise FileExistsError(target) from e
            raise

    def _create(self, path: str):
        system = self._system(path)
        system.setWriteChecksum(False)  # no side file beside what others read
        try:
            return system.create(self._path(path), False)
        finally:
            system.setWriteChecksum(True)

    def write(self, path: str, text: str) -> None:
        """Replace a small file in one step."""
        temporary = f"{path}.{uuid.uuid4().hex}"
        out = self._create(temporary)
        try:
            out.write(bytearray(text.encode()))
            out.hsync()
        finally:
            out.close()
        self.rename(temporary, path, overwrite=True)

    def read(self, path: str) -> str:
        stream = self._system(path).open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def join(self, folder: str, target: str) -> None:
        """The part files of a folder, in order, as one new file; bytes stream, none are held."""
        out = self._create(target)
        try:
            for name in self.names(folder):
                if name.startswith("part-"):
                    part = self._system(folder).open(self._path(f"{folder}/{name}"))
                    try:
                        self.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                    finally:
                        part.close()
            out.hsync()
        finally:
            out.close()
