"""The stored corpus: a current copy of every entity, and the batches since."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import apply_changes, latest_changes
from ..session import exists

def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity a stream keeps with its checkpoint; a new checkpoint is a new stream."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def merged_ranges(ranges: Iterable[Sequence[int]]) -> list[list[int]]:
    """Ranges of batch numbers, both ends within, as few as possible."""
    out: list[list[int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def _together(parts: Iterable[Mapping[str, list]]) -> dict[str, list]:
    """The batches of several segments: ranges by stream."""
    out: dict[str, list] = {}
    for part in parts:
        for stream, ranges in part.items():
            out[stream] = merged_ranges([*out.get(stream, []), *ranges])
    return out


def _holds(batches: Mapping[str, list], stream: str, batch: int) -> bool:
    return any(low <= batch <= high for low, high in batches.get(stream, []))


def due_merge(segments: Sequence[Mapping], fan: int) -> list[Mapping] | None:
    """The segments to be merged next: the lowest level that has ``fan`` of them."""
    levels: dict[int, list[Mapping]] = {}
    for segment in segments:
        levels.setdefault(segment["level"], []).append(segment)
    return next((levels[level] for level in sorted(levels) if len(levels[level]) >= fan), None)


class Corpus:
    """A base version, segments of changes in levels, and a manifest that names them all.

    A batch is reduced to its last change per entity and written as a segment of level 0. Whenever a level has
    ``fan`` segments they become one of the next level, so that n batches are in about ``fan`` times log n
    folders and each change is written again log n times at most; :meth:`compact` folds all
    segments into the next version. Readers open the newest manifest and merge what it names.

    A manifest is complete in itself and small: a line for each folder, the batches in it as ranges by stream.
    Writers put the next number's manifest in place only if there is none yet, and begin anew from the winner's
    otherwise. Of a commit that failed nothing is visible. Batches are told apart by stream and number;
    one that is repeated takes the place of its first writing while that is a segment by itself, and is known
    to be contained after that.
    """

    # Manifests that stay for readers that have opened them.
    KEPT = 100
    _NONE = {"version": None, "base": None, "contains": {}, "segments": []}  # noqa: RUF012

    def __init__(self, spark: SparkSession, path: str, *, fan: int = 8):
        if fan < 2:
            raise ValueError("fan must be 2 or more")
        self.spark, self.path, self.fan = spark, path.rstrip("/"), fan

    def _place(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._place("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        """The manifests there are; KEPT of them or a few more."""
        files, folder = self._files(), self._place("manifests")
        if not files.exists(folder):
            return []
        names = (status.getPath().getName() for status in files.listStatus(folder))
        return sorted(int(name) for name in names if name.isdigit())

    def _manifest(self, number: int | None) -> dict:
        if number is None:
            return self._NONE
        stream = self._files().open(self._place(f"manifests/{number:020d}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def state(self) -> dict:
        """The newest manifest."""
        return self._manifest(max(self._numbers(), default=None))

    def _commit(self, change: Callable[[dict], dict | None]) -> bool:
        """Put in place what ``change`` makes of the newest manifest; again if another writer was first. None changes nothing."""
        jvm = self.spark._jvm
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        while True:
            numbers = self._numbers()
            after = change(self._manifest(max(numbers, default=None)))
            if after is None:
                return False
            number, draft = max(numbers, default=-1) + 1, self._place(f"manifests/draft-{uuid.uuid4().hex}")
            files = self._files()
            out = files.create(draft, False)
            out.write(json.dumps(after).encode())
            out.close()
            target = self._place(f"manifests/{number:020d}")
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
            try:
                context.rename(draft, files.makeQualified(target), options)
            except Py4JJavaError as error:
                files.delete(draft, False)
                if "FileAlreadyExistsException" not in str(error.java_exception):
                    raise
                continue
            for old in numbers[: -self.KEPT]:
                files.delete(self._place(f"manifests/{old:020d}"), False)
            return True

    def version(self) -> int | None:
        """The number of the newest version; None before the first."""
        return self.state()["version"]

    def apply(self, changes: DataFrame, batch_id: int, stream: str = "default") -> None:
        """Take in records with ``seq`` as one batch of ``stream``."""
        folder, own = f"segments/{uuid.uuid4().hex}", {stream: [[batch_id, batch_id]]}
        latest_changes(changes).write.parquet(f"{self.path}/{folder}")

        def add(state: dict) -> dict | None:
            others = [s for s in state["segments"] if s["batches"] != own]
            if any(_holds(held, stream, batch_id) for held in (state["contains"], *(s["batches"] for s in others))):
                return None
            return {**state, "segments": [*others, {"folder": folder, "level": 0, "batches": own}]}

        if not self._commit(add):
            self._files().delete(self._place(folder), True)
            return
        while group := due_merge(self.state()["segments"], self.fan):
            self._merge(group)

    def _read(self, folders: Iterable[str]) -> DataFrame | None:
        found = None
        for folder in sorted(folders):
            part = self.spark.read.parquet(f"{self.path}/{folder}")
            found = part if found is None else found.unionByName(part, allowMissingColumns=True)
        return found

    def _merge(self, group: Sequence[Mapping]) -> None:
        """The segments as one of the next level, which holds the last change of each entity, deletions too."""
        folder, names = f"segments/{uuid.uuid4().hex}", {s["folder"] for s in group}
        latest_changes(self._read(names)).write.parquet(f"{self.path}/{folder}")
        one = {"folder": folder, "level": group[0]["level"] + 1, "batches": _together(s["batches"] for s in group)}

        def swap(state: dict) -> dict | None:
            left = [s for s in state["segments"] if s["folder"] not in names]
            return {**state, "segments": [*left, one]} if len(left) + len(names) == len(state["segments"]) else None

        if not self._commit(swap):
            self._files().delete(self._place(folder), True)

    def writer(self, stream: str) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``; each stream into the corpus needs a name of its own."""
        return lambda batch, batch_id: self.apply(batch, batch_id, stream)

    def stream_writer(self, checkpoint: str) -> Callable[[DataFrame, int], None]:
        """The same, named by the identity in the stream's checkpoint."""
        return lambda batch, batch_id: self.apply(batch, batch_id, stream_id(batch.sparkSession, checkpoint))

    def read(self, upto: Mapping[str, int] | None = None) -> DataFrame | None:
        """The corpus after all batches; of the streams in ``upto``, after the batch named there.

        None when there is nothing yet. A batch beyond ``upto`` that a version or a merged segment contains raises.
        """
        state = self.state()
        segments = state["segments"]
        if upto is not None:
            late = lambda batches: {k for k, n in upto.items() if any(high > n for _, high in batches.get(k, []))}
            whole = [state["contains"], *(s["batches"] for s in segments if s["level"])]
            for stream in sorted(set().union(*map(late, whole))):
                raise ValueError(f"batches of {stream} beyond {upto[stream]} are part of the newest version or of a merged segment")
            segments = [s for s in segments if not late(s["batches"])]
        base = None if state["base"] is None else self.spark.read.parquet(f"{self.path}/{state['base']}")
        return base if not segments else apply_changes(base, self._read(s["folder"] for s in segments))

    def compact(self) -> int | None:
        """Write the corpus after all batches as a version; returns the newest one's number."""
        state = self.state()
        if state["segments"]:
            folder, names = f"versions/{uuid.uuid4().hex}", {s["folder"] for s in state["segments"]}
            base = None if state["base"] is None else self.spark.read.parquet(f"{self.path}/{state['base']}")
            apply_changes(base, self._read(names)).write.parquet(f"{self.path}/{folder}")

            def fold(now: dict) -> dict | None:
                left = [s for s in now["segments"] if s["folder"] not in names]
                if now["base"] != state["base"] or len(left) + len(names) != len(now["segments"]):
                    return None
                contains = _together([now["contains"], *(s["batches"] for s in state["segments"])])
                return {"version": (-1 if now["version"] is None else now["version"]) + 1, "base": folder, "contains": contains, "segments": left}

            if not self._commit(fold):
                self._files().delete(self._place(folder), True)
        return self.version()

    def clean(self) -> int:
        """Delete the folders that none of the kept manifests names; returns how many. For times without writers."""
        named = set()
        for number in self._numbers():
            state = self._manifest(number)
            named |= {state["base"], *(s["folder"] for s in state["segments"])}
        files, gone = self._files(), 0
        for kind in ("segments", "versions"):
            if files.exists(self._place(kind)):
                for status in files.listStatus(self._place(kind)):
                    name = f"{kind}/{status.getPath().getName()}"
                    if name not in named:
                        files.delete(self._place(name), True)
                        gone += 1
        return gone


class TokenState:
    """The next token per resource, for audit and for batch reruns.

    A running stream resumes from its checkpoint; this table tells where a batch run would go on.
    Rows are only ever added; the last writing of a resource counts, whatever its stream and batch.
    Under the batch BEGIN a stream keeps the token it began from, which is no result of a batch.
    """

    BEGIN = -1

    _ROW = "entry bigint, stream string, batch bigint, resource string, next_token bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _history(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self._ROW)
        return self.spark.read.schema(self._ROW).json(self.path)

    def write(self, tokens: DataFrame, batch_id: int, stream: str = "default") -> None:
        """Keep ``tokens(resource, next_token)`` as of one batch."""
        entry = (self._history().agg(F.max("entry")).first()[0] or 0) + 1
        tokens.select(
            F.lit(entry).alias("entry"),
            F.lit(stream).alias("stream"),
            F.lit(batch_id).cast("bigint").alias("batch"),
            "resource",
            F.col("next_token").cast("bigint").alias("next_token"),
        ).write.mode("append").json(self.path)

    def read(self) -> DataFrame:
        """The newest token per resource."""
        return self._history().where(F.col("batch") > self.BEGIN).groupBy("resource").agg(F.max_by("next_token", "entry").alias("next_token"))

    def read_before(self, resource: str, stream: str, batch_id: int) -> int | None:
        """The resource's newest token, those that ``stream`` wrote from ``batch_id`` on left out."""
        own = (F.col("stream") == stream) & (F.col("batch") >= batch_id)
        rows = self._history().where((F.col("resource") == resource) & ~own & (F.col("batch") > self.BEGIN))
        return rows.agg(F.max_by("next_token", "entry")).first()[0]

    def begin(self, resource: str, stream: str, token: int) -> int:
        """The token that ``stream`` began the resource from: the one kept, or else ``token``, which is kept from now on."""
        kept = self._history().where((F.col("resource") == resource) & (F.col("stream") == stream) & (F.col("batch") == self.BEGIN))
        found = kept.agg(F.min_by("next_token", "entry")).first()[0]
        if found is not None:
            return found
        row = self.spark.createDataFrame([(resource, token)], "resource string, next_token bigint")
        self.write(row, self.BEGIN, stream)
        return token
