"""Small files and folder names below a shared path, from the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class SharedFolder:
    """A path of any file system Spark can reach."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._sc = spark.sparkContext
        self._hadoop = self._sc._jvm.org.apache.hadoop.fs
        self._conf = self._sc._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")

    def _at(self, name: str):
        path = self._hadoop.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        path, fs = self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def files(self, folder: str) -> list[str]:
        """Names below a folder, at any depth, of files that Spark reads."""
        path, fs = self._at(folder)
        found, walk = [], fs.listFiles(path, True)
        while walk.hasNext():
            name = walk.next().getPath().toUri().getPath()
            if not name.rsplit("/", 1)[1].startswith(("_", ".")):
                found.append(name[len(path.toUri().getPath()) + 1 :])
        return sorted(found)

    def set_time(self, name: str, epoch_ms: int) -> None:
        path, fs = self._at(name)
        fs.setTimes(path, epoch_ms, -1)

    def size(self, folder: str) -> int:
        path, fs = self._at(folder)
        return fs.getContentSummary(path).getLength()

    def read(self, name: str) -> str:
        path, fs = self._at(name)
        stream = fs.open(path)
        try:
            return self._sc._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A new file that is whole from the moment it can be seen; an error if the name is taken."""
        path, fs = self._at(name)
        draft, _ = self._at(f"{name}.{uuid.uuid4().hex}.draft")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        context = self._hadoop.FileContext.getFileContext(path.toUri() if path.toUri().getScheme() else fs.getUri(), self._conf)
        no_options = self._sc._gateway.new_array(self._hadoop.Options.Rename, 0)
        context.rename(fs.makeQualified(draft), fs.makeQualified(path), no_options)

    def delete(self, name: str) -> None:
        path, fs = self._at(name)
        fs.delete(path, True)
