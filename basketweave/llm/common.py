"""Helpers that the operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketweave.workspace import Workspace

# A word is a run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# What a worker remembers between words, per operator, and what an entry takes besides its
# characters; and the texts of an Arrow batch that are worked on at once.
CACHE_BYTES, ENTRY_BYTES = 24 << 20, 160
SLICE_BYTES = 4 << 20

ROOT = str(Path(__file__).resolve().parents[2])

ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession) -> Workspace:
    """A new folder of intermediate tables under ``spark.checkpoint.dir``."""
    return Workspace(spark)


def words(text: Column) -> Column:
    """All words of a text, in order; none for a null text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package.

    A cluster ships it with ``--py-files``; workers on this machine find it where the
    driver has it.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


_held: dict[str, tuple] = {}


def held(operator: str, key, make: Callable):
    """What a worker keeps of one operator for its next task, made anew for another `key`.

    Spark uses a worker again for the stages that follow, so whatever another operator
    left there goes first.
    """
    if operator not in _held or _held[operator][0] != key:
        _held.clear()
        _held[operator] = key, make()
    return _held[operator][1]


class Memo(dict):
    """What `work` gives for each word, remembered up to CACHE_BYTES, then forgotten."""

    def __init__(self, work: Callable):
        super().__init__()
        self.work, self.room = work, CACHE_BYTES

    def __missing__(self, word):
        value = self.work(word)
        size = ENTRY_BYTES + len(word)
        if size > self.room:
            self.clear()
            self.room = CACHE_BYTES
        self.room -= size
        self[word] = value
        return value


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about SLICE_BYTES, as Python objects take several times that."""
    rows = max(1, SLICE_BYTES * batch.num_rows // max(batch.nbytes, 1))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_arrow(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` by a function of this package."""
    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_batches(
    df: DataFrame, make: Callable[[], Callable[..., dict]], schema: str
) -> DataFrame:
    """Map the rows of `df` batch by batch, in Python workers.

    `make` runs once per task and gives the function that turns the columns of one
    Arrow batch, as lists, into the columns of the result, as lists or arrays. Spark
    bounds a batch in rows and bytes, so a task holds one batch at a time.
    """
    columns = [column.split() for column in schema.split(", ")]
    names, types = [n for n, _ in columns], [ARROW[t] for _, t in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in _slices(batch):
                out = step(*(column.to_pylist() for column in part.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[n], type=t) for n, t in zip(names, types, strict=True)],
                    names=names,
                )

    return map_arrow(df, run, schema)


def filter_batches(
    df: DataFrame, columns: list[str], make: Callable[[], Callable[..., list[bool]]]
) -> DataFrame:
    """The rows of `df` for which a Python function of `columns` holds; all columns stay.

    `make` runs once per task and gives a function from the columns of one Arrow batch
    to whether each row stays. No row is shuffled or matched by an id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds = make()
        for batch in batches:
            for part in _slices(batch):
                values = [part.column(c).to_pylist() for c in columns]
                yield part.filter(pa.array(holds(*values), pa.bool_()))

    return map_arrow(df, run, df.schema)
