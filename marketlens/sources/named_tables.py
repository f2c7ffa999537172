"""Tables with a name that lasts: versions side by side, and one step that switches the name."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from marketlens.sources.tables import shared_folder


class NamedTable:
    """A table that sessions share by its name.

    Every write makes a folder of its own and then a version file, numbered one above the
    last, that names the folder. The version file appears whole, by a rename that fails if the
    number is taken, so readers see the table before or after, and of two writers one
    takes the next number. Readers resolve the name once and keep their folder until
    ``drop_old`` gives it up. A write may change the columns.

    The store's rename must be atomic, as that of HDFS, local files or a store with
    a committer in front is.
    """

    def __init__(self, spark: SparkSession, name: str):
        if not re.fullmatch(r"\w+", name):
            raise ValueError(f"not a table name: {name!r}")
        self.spark, self.name = spark, name
        self.root = f"{shared_folder(spark)}/named/{name}"
        self._jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._store = self._path().getFileSystem(conf)
        place = self._store.makeQualified(self._path()).toUri()
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place, conf)

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def versions(self) -> list[int]:
        """Numbers of the versions that can still be read, the current one last."""
        folder = self._path("versions")
        if not self._store.exists(folder):
            return []
        return sorted(int(s.getPath().getName()) for s in self._store.listStatus(folder))

    def write(self, df: DataFrame) -> int:
        """Make ``df`` the table's content; returns the number of its version."""
        content = uuid.uuid4().hex
        df.write.parquet(f"{self.root}/data/{content}")
        draft = self._path("drafts", content)
        out = self._store.create(draft, False)
        out.write(bytearray(content.encode()))
        out.close()
        self._store.mkdirs(self._path("versions"))
        number = max(self.versions(), default=0) + 1
        while not self._taken(draft, number):
            number += 1
        return number

    def _taken(self, draft, number: int) -> bool:
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        plain = self.spark.sparkContext._gateway.new_array(kind, 0)
        try:
            self._context.rename(draft, self._path("versions", str(number)), plain)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def _folder(self, number: int) -> str:
        source = self._store.open(self._path("versions", str(number)))
        content = bytes(source.readAllBytes()).decode()
        source.close()
        return f"{self.root}/data/{content}"

    def read(self, version: int | None = None) -> DataFrame:
        """The current content, or that of a version that has not been dropped."""
        known = self.versions()
        if not known or version is not None and version not in known:
            raise ValueError(f"no version {version or ''} of table {self.name}".replace("  ", " "))
        return self.spark.read.parquet(self._folder(known[-1] if version is None else version))

    def drop_old(self, keep: int = 1) -> list[int]:
        """Give up all but the last ``keep`` versions; returns the numbers given up."""
        old = self.versions()[:-keep] if keep else self.versions()
        for number in old:
            folder = self._jvm.org.apache.hadoop.fs.Path(self._folder(number))
            self._store.delete(self._path("versions", str(number)), False)
            self._store.delete(folder, True)
        return old
