"""What several operators share: tables, stored intermediate results, worker-wide objects."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import fresh_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder, so that a lost executor never recomputes it."""
    folder = fresh_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def kept(name: str, make: Callable[[], object]) -> object:
    """One object per worker process, kept between its tasks."""
    home = sys.modules.setdefault("tallybridge_worker", types.ModuleType("tallybridge_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


class Sent:
    """An object sent to every task once, class and all, so that no worker needs this package to read it."""

    def __init__(self, spark: SparkSession, thing: object):
        self._bytes, self._thing = spark.sparkContext.broadcast(cloudpickle.dumps(thing)), None

    @property
    def value(self) -> object:
        if self._thing is None:
            self._thing = cloudpickle.loads(self._bytes.value)
        return self._thing


def by_batch(
    df: DataFrame, schema: str | T.StructType, function: Callable[[pa.RecordBatch], Iterable[dict]]
) -> DataFrame:
    """``function`` turns each Arrow batch into column dicts; schema is what they hold."""
    kind = df.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    arrow, names = to_arrow_schema(kind), df.columns
    if any(sign in name for name in names for sign in ".`"):  # Spark would look them up as paths
        df = df.toDF(*[f"c{n}" for n in range(len(names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.rename_columns(names)
            for columns in function(batch):
                yield pa.RecordBatch.from_arrays(
                    [
                        values if isinstance(values := columns[f.name], pa.Array) and values.type == f.type
                        else values.cast(f.type) if isinstance(values, pa.Array)
                        else pa.array(values, f.type)
                        for f in arrow
                    ],
                    schema=arrow,
                )

    return df.mapInArrow(run, kind)


def in_fold(id_column: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == fold, F.lit(False))


def all_columns(df: DataFrame) -> list[Column]:
    """Every column of ``df``, whatever signs its name has."""
    return [F.col(f"`{name.replace('`', '``')}`") for name in df.columns]


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns; those that hold maps, which have no hash, count as JSON."""
    hashed = [
        F.to_json(column) if any(kind in field.dataType.json() for kind in ('"map"', '"variant"')) else column
        for field, column in zip(df.schema, all_columns(df), strict=True)
    ]
    return F.xxhash64(*hashed)


def clear_of(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` clashes."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
