"""Large file trees: folders listed and files read by tasks, without a list of paths on the driver."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Staging

# Bytes and files that a task reads, about.
TASK_BYTES, TASK_FILES = 128 << 20, 10_000
_BATCH_BYTES = 32 << 20
_ENTRY = "path string, is_folder boolean, size bigint"


def list_tree(spark: SparkSession, root: str, staging: Staging, *, tasks: int | None = None) -> DataFrame:
    """``path`` (below ``root``) and ``size`` of every file, folder by folder on the executors.

    A round lists the folders that the round before has found and writes down what is in them, so there are as
    many rounds as the tree is deep, and a lost executor costs a part of one. Links are listed as files as far as
    the store tells them apart. A folder that cannot be read fails the job. ``root`` is an address
    or path that every executor can open.
    """
    tasks = tasks or spark.sparkContext.defaultParallelism
    root = root.rstrip("/")

    def listed(batches: Iterable[pa.RecordBatch]):
        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                place = f"{base}/{folder}" if folder else base
                found = store.get_file_info(fs.FileSelector(place))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{folder}/{e.base_name}" if folder else e.base_name for e in found], pa.string()),
                        pa.array([e.type == fs.FileType.Directory for e in found], pa.bool_()),
                        pa.array([e.size or 0 for e in found], pa.int64()),
                    ],
                    names=["path", "is_folder", "size"],
                )

    folders, depth = spark.createDataFrame([("",)], "path string"), 0
    while True:
        level = staging.write(folders.repartition(tasks).mapInArrow(listed, _ENTRY), f"tree/depth={depth}")
        folders = level.where("is_folder").select("path")
        if folders.isEmpty():
            return spark.read.schema(_ENTRY).parquet(f"{staging.path}/tree").where("NOT is_folder").select("path", "size")
        depth += 1


def read_tree(
    spark: SparkSession,
    root: str,
    staging: Staging,
    *,
    repo: str | Column | None = None,
    branch: str = "main",
    commit_sha: str | None = None,
    task_bytes: int = TASK_BYTES,
    task_files: int = TASK_FILES,
) -> DataFrame:
    """(repo, branch, commit_sha, path, content) of a checked-out tree of any size; an unreadable file has NULL content.

    The files are dealt out by size: sorted ranges of the running sum of sizes would need one task, so each file
    goes to one of as many tasks as the bytes and files ask for, large ones spread evenly first.
    """
    root = root.rstrip("/")
    files = list_tree(spark, root, staging)
    total, count = files.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(1, -(-total // task_bytes), -(-count // task_files))

    def contents(batches: Iterable[pa.RecordBatch]):
        store, base = fs.FileSystem.from_uri(root)

        def batch_of(paths, bodies):
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(bodies, pa.binary())], names=["path", "content"])

        paths, bodies, held = [], [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    with store.open_input_stream(f"{base}/{path}") as file:
                        body = file.read()
                except OSError:
                    body = None
                paths.append(path)
                bodies.append(body)
                held += len(body or b"")
                if held >= _BATCH_BYTES or len(paths) >= 10_000:
                    yield batch_of(paths, bodies)
                    paths, bodies, held = [], [], 0
        if paths:
            yield batch_of(paths, bodies)

    # Files of about one size are spread over all tasks in turn, so each task has its share of the large ones.
    dealt = files.repartition(parts, F.floor(F.log2(F.col("size") + 1)), F.xxhash64("path")) if parts > 1 else files.coalesce(1)
    name = F.lit(root) if repo is None else F.lit(repo) if isinstance(repo, str) else repo
    read = dealt.select("path").mapInArrow(contents, "path string, content binary")
    return read.select(name.alias("repo"), F.lit(branch).alias("branch"), F.lit(commit_sha).cast("string").alias("commit_sha"), "path", "content")
