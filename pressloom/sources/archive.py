"""The store of published issues."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from pressloom.schemas import ARTICLE

_FILE_DATE = r"articles-(\d{4}-\d{2}-\d{2})\.json$"
_STORED = T.StructType(
    [T.StructField("position", T.LongType()), *ARTICLE.fields, T.StructField("issue_date", T.DateType())]
)


def write_archive(articles: DataFrame, path: str) -> None:
    """Store enriched articles, one folder per ``issue_date``.

    Writing an issue again replaces that issue and leaves the others alone. Rows of an issue
    are brought together so that it does not shatter into small files; the rebalance splits
    an issue that is too large for one task.
    """
    (
        articles.select(*[f.name for f in _STORED.fields])
        .hint("rebalance", "issue_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy("issue_date")
        .json(path)
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Read the store back; a filter on ``issue_date`` prunes folders."""
    return spark.read.schema(_STORED).json(path)


class IssueFiles(DataSource):
    """Writes rows of ``(name, body)`` as whole files of those names, all of them or none.

    Tasks write beside the final names; once all are done the driver moves the files into place, each
    replacing the one before. A run that fails removes what it wrote and leaves the old files alone. The
    folder may be on any file system that pyarrow can reach.
    """

    @classmethod
    def name(cls) -> str:
        return "pressloom_issue_files"

    def writer(self, schema: T.StructType, overwrite: bool) -> _IssueWriter:
        return _IssueWriter(self.options["path"])


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]  # temporary and final


class _IssueWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.run = path, uuid.uuid4().hex

    def _folder(self) -> tuple[FileSystem, str]:
        return FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{os.path.abspath(self.path)}")

    def write(self, rows: Iterator[Row]) -> _Written:
        files, folder = self._folder()
        files.create_dir(f"{folder}/_{self.run}", recursive=True)
        done = []
        for name, body in rows:
            # A task may run twice; each attempt has files of its own.
            part = f"{folder}/_{self.run}/{uuid.uuid4().hex}"
            with files.open_output_stream(part) as out:
                out.write(body.encode())
            done.append((part, f"{folder}/{name}"))
        return _Written(done)

    def commit(self, messages: list[_Written | None]) -> None:
        files, folder = self._folder()
        for message in filter(None, messages):
            for part, final in message.files:
                files.move(part, final)
        self._clear(files, folder)

    def abort(self, messages: list[_Written | None]) -> None:
        self._clear(*self._folder())

    def _clear(self, files: FileSystem, folder: str) -> None:
        if files.get_file_info(f"{folder}/_{self.run}").type == FileType.Directory:
            files.delete_dir(f"{folder}/_{self.run}")


def write_issue_files(articles: DataFrame, path: str) -> None:
    """Store each issue as ``articles-<date>.json``, one JSON array of the nine article keys in order.

    An issue has a bounded number of articles, so its file is put together in one task. Issues that
    are not among ``articles`` keep their files; see :class:`IssueFiles`.
    """
    spark = articles.sparkSession
    spark.dataSource.register(IssueFiles)
    article = F.struct(*[f.name for f in ARTICLE.fields])
    issues = articles.groupBy("issue_date").agg(F.array_sort(F.collect_list(F.struct("position", article.alias("a")))).alias("rows"))
    body = F.to_json(F.transform("rows", lambda r: r["a"]), {"ignoreNullFields": "false"})
    name = F.concat(F.lit("articles-"), F.date_format("issue_date", "yyyy-MM-dd"), F.lit(".json"))
    issues.select(name.alias("name"), body.alias("body")).write.format(IssueFiles.name()).mode("append").save(path)


def read_issue_files(spark: SparkSession, path: str) -> DataFrame:
    """Read ``articles-<date>.json`` files, each one JSON array of the nine article keys.

    The place in the array becomes ``position``, the date in the file name ``issue_date``.
    A file holds one issue, so reading it whole is bounded by the size of an issue. A file that is no
    such array, or whose name holds no date, gives a row with ``unreadable`` set.
    """
    records = F.from_json(F.col("value"), T.ArrayType(ARTICLE))
    return (
        spark.read.text(path, wholetext=True)
        .select(
            F.regexp_extract(F.col("_metadata.file_name"), _FILE_DATE, 1).alias("day"),
            records.isNull().alias("broken"),
            F.posexplode_outer(records).alias("pos", "a"),
        )
        .filter("broken or pos is not null")  # an empty array is an empty issue
        .select(
            (F.col("pos") + 1).cast("bigint").alias("position"),
            "a.*",
            F.try_to_date("day").alias("issue_date"),
            (F.col("broken") | F.try_to_date("day").isNull()).alias("unreadable"),
        )
    )
