"""Reading tables and running Python over bounded batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# A Python worker holds one such batch at a time, however long the texts are.
BATCH_ROWS = 256
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


# What a worker keeps between tasks, by name, and the names that its task has asked for.
_KEPT: dict[tuple, object] = {}
_ASKED: set[tuple] = set()


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` returns, kept by the worker for as long as its tasks ask for it."""
    _ASKED.add(key)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def _begun(make: Callable[[], object]) -> object:
    """What a task works with. A worker serves the stages in turn: it lets go of what only those before asked for."""
    _ASKED.clear()
    work = make()
    for key in set(_KEPT) - _ASKED:
        del _KEPT[key]
    pa.default_memory_pool().release_unused()
    return work


def map_columns(df: DataFrame, schema: str, make: Callable[[], Callable[..., Sequence]]) -> DataFrame:
    """``make()`` runs once a task and returns a function from a batch's columns, as lists, to the
    columns of ``schema``. Rows may be made or dropped; nulls stay ``None``."""
    small_batches(df.sparkSession)
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        work = _begun(make)
        for batch in batches:
            out = work(*(column.to_pylist() for column in batch.columns))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, type=field.type) for values, field in zip(out, fields, strict=True)], schema=fields
            )

    return df.mapInArrow(run, schema)


def fold_columns(
    df: DataFrame, schema: str, make: Callable[[], tuple[Callable[..., None], Callable[[], Sequence]]]
) -> DataFrame:
    """``make()`` returns a function that takes in each batch of a task, and one that gives the task's rows at its end."""
    small_batches(df.sparkSession)
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        take, finish = _begun(make)
        for batch in batches:
            take(*(column.to_pylist() for column in batch.columns))
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, type=field.type) for values, field in zip(finish(), fields, strict=True)], schema=fields
        )

    return df.mapInArrow(run, schema)


def grouped(rows: DataFrame, keys: list[str], schema: str, work: Callable[[tuple, list[tuple]], Iterable[tuple]]) -> DataFrame:
    """``work(key, rows)`` for the rows of each key, without the key's columns; a key's rows are bounded by the caller."""
    small_batches(rows.sparkSession)
    fields = to_arrow_schema(StructType.fromDDL(schema))
    width, rest = len(keys), [c for c in rows.columns if c not in keys]

    def run(batches: Iterable[pa.RecordBatch]):
        _begun(lambda: None)
        key, held = None, []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:width] != key:
                    if len(held) > 1:
                        out += work(key, held)
                    key, held = row[:width], []
                held.append(row[width:])
            if len(out) > 1000:
                yield _rows_batch(out, fields)
                out = []
        if len(held) > 1:
            out += work(key, held)
        yield _rows_batch(out, fields)

    return rows.repartition(*keys).sortWithinPartitions(*keys).select(*keys, *rest).mapInArrow(run, schema)


def _rows_batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(fields)], schema=fields)


def filter_texts(docs: DataFrame, text_col: str, make: Callable[[], Callable[[list[str]], Sequence[bool]]]) -> DataFrame:
    """The rows whose text ``make()``'s function keeps, all columns as they are; a null text is asked about as an empty one."""
    small_batches(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches):
        keep = _begun(make)
        for batch in batches:
            yield batch.filter(pa.array(keep([t or "" for t in batch.column(place).to_pylist()]), type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def replace_texts(docs: DataFrame, text_col: str, make: Callable[[], Callable[[str], str]]) -> DataFrame:
    """All rows, the text as ``make()``'s function gives it back; null texts stay null."""
    small_batches(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches):
        work = _begun(make)
        for batch in batches:
            new = [None if t is None else work(t) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(new, type=batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names, null texts as empty ones."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fold_of(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(id_column.cast("string")) % folds, F.lit(0)).cast("int")
