"""File-system steps of the driver: names, sizes, small files, renames. No data passes here."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SMALL_FILE = 64 << 20


class Files:
    """Paths of any file system that the session's Hadoop settings know."""

    def __init__(self, spark: SparkSession):
        self._sc = spark.sparkContext
        self._hadoop = self._sc._jvm.org.apache.hadoop  # noqa: SLF001
        self._conf = self._sc._jsc.hadoopConfiguration()  # noqa: SLF001

    def _path(self, uri: str):
        path = self._hadoop.fs.Path(uri)
        fs = path.getFileSystem(self._conf)
        return fs, fs.makeQualified(path)

    def qualified(self, uri: str) -> str:
        return self._path(uri)[1].toString()

    def exists(self, uri: str) -> bool:
        fs, path = self._path(uri)
        return fs.exists(path)

    def size(self, uri: str) -> int:
        fs, path = self._path(uri)
        return fs.getFileStatus(path).getLen()

    def make(self, uri: str) -> None:
        fs, path = self._path(uri)
        fs.mkdirs(path)

    def create_new(self, uri: str, text: str = "") -> bool:
        """Create a small file; of several callers exactly one succeeds, the others get False."""
        fs, path = self._path(uri)
        fs.mkdirs(path.getParent())
        if path.toUri().getScheme() == "file":
            # Hadoop's local file system looks first and creates afterwards; the platform's call does both at once
            try:
                with open(path.toUri().getPath(), "x") as out:
                    out.write(text)
            except FileExistsError:
                return False
            return True
        try:
            out = fs.create(path, False)
        except Exception as e:  # noqa: BLE001 - Py4J wraps the file system's error
            if fs.exists(path):
                return False
            raise OSError(f"cannot create {uri}") from e
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def time(self, uri: str) -> int:
        """When a file was last written, in ms of the file system's own clock."""
        fs, path = self._path(uri)
        return fs.getFileStatus(path).getModificationTime()

    def listed(self, uri: str) -> list[tuple[str, bool, int, int]]:
        """(name, is a folder, bytes, time in ms) of a folder's entries."""
        fs, path = self._path(uri)
        return [
            (s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path)
        ]

    def names(self, uri: str) -> list[str]:
        return [name for name, *_ in self.listed(uri)]

    def sizes(self, uri: str) -> list[tuple[str, int]]:
        return [(name, size) for name, folder, size, _ in self.listed(uri) if not folder]

    def matching(self, pattern: str) -> list[tuple[str, bool, int]]:
        """(full path, is a folder, bytes) of what a path or glob names."""
        fs, path = self._path(pattern)
        found = fs.globStatus(path)
        return [(s.getPath().toString(), s.isDirectory(), s.getLen()) for s in found or []]

    def read_small(self, uri: str) -> str:
        """A small file's text."""
        if self.size(uri) > SMALL_FILE:
            raise ValueError(f"{uri} is too large to be read here")
        fs, path = self._path(uri)
        stream = fs.open(path)
        try:
            return bytes(self._sc._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()  # noqa: SLF001
        finally:
            stream.close()

    def replace(self, uri: str, text: str) -> None:
        """Put a small file in place of the one there, at once."""
        temporary = f"{uri}.{uuid.uuid4().hex}"
        fs, path = self._path(temporary)
        fs.mkdirs(path.getParent())
        out = fs.create(path, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move_over(temporary, uri)

    def move(self, source: str, target: str) -> None:
        fs, path = self._path(source)
        if not fs.rename(path, self._path(target)[1]):
            raise OSError(f"cannot rename {source} to {target}")

    def move_over(self, source: str, target: str) -> None:
        """Rename a file onto another: at no time is there none."""
        path, onto = self._path(source)[1], self._path(target)[1]
        self._path(target)[0].mkdirs(onto.getParent())
        options = self._hadoop.fs.Options.Rename
        replace = self._sc._gateway.new_array(options, 1)  # noqa: SLF001
        replace[0] = options.OVERWRITE
        self._hadoop.fs.FileContext.getFileContext(onto.toUri(), self._conf).rename(path, onto, replace)

    def concat(self, parts: list[str]) -> bool:
        """Append the other parts to the first inside the file system; False if it cannot."""
        fs, first = self._path(parts[0])
        others = self._sc._gateway.new_array(self._hadoop.fs.Path, len(parts) - 1)  # noqa: SLF001
        for k, part in enumerate(parts[1:]):
            others[k] = self._path(part)[1]
        try:
            fs.concat(first, others)
        except Exception as e:  # noqa: BLE001 - Py4J wraps the file system's error
            if "UnsupportedOperation" in str(e):
                return False
            raise
        return True

    def remove(self, uri: str) -> None:
        fs, path = self._path(uri)
        fs.delete(path, True)
