"""Where dumps come from."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


class Source(Protocol):
    """What ``run.run_latest`` needs of a place that holds dumps."""

    def files(self) -> DataFrame:
        """(path, file, version, size) of all files."""

    def latest(self) -> str | None:
        """The newest complete version."""

    def paths(self, version: str) -> list[str]:
        """The dumps of a version."""

    def checksums(self, version: str) -> DataFrame:
        """(file, sha256) as the version's checksum list has them."""


class FolderSource:
    """A folder of landed files in any store that Spark reads."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def files(self) -> DataFrame:
        from dumpmill.sources.files import list_folder

        return list_folder(self.spark, self.folder).where("version is not null")

    def latest(self) -> str | None:
        from dumpmill.sources.files import latest_complete

        row = latest_complete(self.files()).select("version").head()
        return row[0] if row else None

    def paths(self, version: str) -> list[str]:
        own = self.files().where(f"version = '{version}' and file like '%.xml.gz'").orderBy("file")
        return [r.path for r in own.select("path").collect()]  # a version has four dumps

    def checksums(self, version: str) -> DataFrame:
        from dumpmill.sources.files import checksum_file, read_checksums

        own = checksum_file(self.files()).where(f"version = '{version}'").join(self.files().select("file", "path").toDF("checksum_file", "list"), "checksum_file")
        return read_checksums(self.spark, own.select("list").head()[0])
