"""A checked-out repository tree as a table.

Spark's own file sources leave out files whose names start with an underscore; this one does not.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schemas import REPO_FILE

_BATCH_BYTES = 32 << 20


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class RepoTreeSource(DataSource):
    """``spark.read.format("repo_tree").option("repo", ...).option("branch", ...).load(root)``.

    Rows are (repo, branch, commit_sha, path, content); an unreadable file has NULL content. The
    root must be a folder every executor sees. Work is dealt out in lists of files of bounded number
    and size, however the tree is shaped; the list is made on the driver, without opening a file. A
    folder that cannot be read fails the scan. Linked folders are neither rows nor followed.
    """

    @classmethod
    def name(cls) -> str:
        return "repo_tree"

    def schema(self) -> str:
        return REPO_FILE

    def reader(self, schema) -> DataSourceReader:
        return _RepoTreeReader(self.options)


class _RepoTreeReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"].rstrip("/")
        self.repo = options.get("repo", self.root)
        self.branch = options.get("branch", "main")
        self.commit = options.get("commit_sha")
        self.files = int(options.get("files_per_partition", "10000"))
        self.bytes = int(options.get("bytes_per_partition", str(128 << 20)))

    def partitions(self) -> list[InputPartition]:
        found: list[InputPartition] = []
        paths, size = [], 0
        for entry in self._entries():
            paths.append(entry.path)
            size += entry.stat(follow_symlinks=False).st_size
            if len(paths) >= self.files or size >= self.bytes:
                found.append(_Files(paths))
                paths, size = [], 0
        return [*found, _Files(paths)]

    def _entries(self) -> Iterator[os.DirEntry]:
        folders = [self.root]
        while folders:
            with os.scandir(folders.pop()) as entries:
                for entry in entries:
                    if entry.is_dir(follow_symlinks=False):
                        folders.append(entry.path)
                    elif not (entry.is_symlink() and entry.is_dir()):
                        yield entry

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for path in partition.paths:
            try:
                with open(path, "rb") as file:
                    content = file.read()
            except OSError:
                content = None
            rows.append((os.path.relpath(path, self.root), content))
            size += len(content or b"")
            if size >= _BATCH_BYTES or len(rows) >= 10_000:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.repo] * n, pa.string()),
                pa.array([self.branch] * n, pa.string()),
                pa.array([self.commit] * n, pa.string()),
                pa.array([path for path, _ in rows], pa.string()),
                pa.array([content for _, content in rows], pa.binary()),
            ],
            names=["repo", "branch", "commit_sha", "path", "content"],
        )


def register(spark) -> None:
    spark.dataSource.register(RepoTreeSource)
