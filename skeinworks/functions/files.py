"""Small files on any file system that Spark reaches: read whole, put once, listed, removed."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see: under ``spark.checkpoint.dir``, or a temporary one where executors are this process."""
    told = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not told and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{told or tempfile.mkdtemp(prefix='skeinworks-')}/{uuid.uuid4().hex}"


class Files:
    """Names are relative to ``root``, a path or address."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def at(self, name: str = "") -> tuple:
        """The Hadoop path of a name and its file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, name: str = "") -> bool:
        path, fs = self.at(name)
        return fs.exists(path)

    def names(self, name: str = "") -> dict[str, int]:
        """What a folder holds, with the time of its last change in milliseconds; nothing for a missing one."""
        path, fs = self.at(name)
        return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(path)} if fs.exists(path) else {}

    def sizes(self, name: str) -> dict[str, int]:
        """What a folder holds, with its bytes."""
        path, fs = self.at(name)
        return {s.getPath().getName(): fs.getContentSummary(s.getPath()).getLength() for s in fs.listStatus(path)} if fs.exists(path) else {}

    def read(self, name: str) -> str | None:
        path, fs = self.at(name)
        try:
            stream = fs.open(path)
        except Py4JJavaError as e:
            if "FileNotFound" in str(e.java_exception):
                return None
            raise
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str = "") -> bool:
        path, fs = self.at(name)
        return fs.delete(path, True)

    def _written(self, name: str, text: str) -> str:
        """A file of its own beside ``name``, whole."""
        folder, _, last = name.rpartition("/")
        part = f"{folder}/.{last}-{uuid.uuid4().hex}" if folder else f".{last}-{uuid.uuid4().hex}"
        path, fs = self.at(part)
        stream = fs.create(path, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return part

    def put_if_absent(self, name: str, text: str) -> bool:
        """Write a file under a name that nobody has; False if somebody has it. Readers see it whole or not at all.

        On local and mounted folders by a hard link, elsewhere by a rename that doesn't overwrite, which the file system must do atomically.
        """
        part = self._written(name, text)
        scheme = urlparse(self.root).scheme
        try:
            if scheme in ("", "file") and self.at()[1].getScheme() == "file":
                folder = urlparse(self.root).path if scheme else self.root
                try:
                    os.link(f"{folder}/{part}", f"{folder}/{name}")
                except FileExistsError:
                    return False
                return True
            return self._renamed(part, name)
        finally:
            self.delete(part)

    def _renamed(self, part: str, name: str) -> bool:
        fs = self.spark._jvm.org.apache.hadoop.fs
        rename = getattr(fs, "Options$Rename")
        never = self.spark.sparkContext._gateway.new_array(rename, 1)
        never[0] = rename.NONE
        to = self.at(name)[0]
        try:
            fs.FileContext.getFileContext(to.toUri(), self.spark._jsc.hadoopConfiguration()).rename(self.at(part)[0], to, never)
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e.java_exception):
                return False
            raise
        return True

    def replace(self, name: str, text: str) -> None:
        """Write a file over the one that is there; for one writer."""
        part = self._written(name, text)
        path, fs = self.at(name)
        if not fs.rename(self.at(part)[0], path):  # not every file system renames onto a file
            fs.delete(path, False)
            fs.rename(self.at(part)[0], path)
