"""Helpers shared by the operators: table access, passing rows through Arrow functions, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import release, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` made and that nothing reads any more."""
    for t in tables:
        for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
            release(t.sparkSession, folder)


def with_python_columns(df: DataFrame, column: str, extra: list[T.StructField],
                        make: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """``df`` and, after its own columns, the columns that ``make`` derives from string column ``column``.

    Rows stay where they are (no shuffle) and every column of ``df`` passes through. Inside, columns go by position,
    so a name in ``df`` that equals one in ``extra`` does no harm there; the caller selects by name afterwards, so such
    a column of ``df`` is dropped in favour of the new one.
    """
    names = df.columns
    at = names.index(column)
    new = {f.name for f in extra}
    hidden = df.toDF(*[f"c{i}" for i in range(len(names))])
    schema = T.StructType([*hidden.schema.fields, *[T.StructField(f"x{i}", f.dataType, True) for i, f in enumerate(extra)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    out = hidden.mapInArrow(run, schema)
    keep = [out[f"c{i}"].alias(n) for i, n in enumerate(names) if n not in new]
    return out.select(*keep, *[out[f"x{i}"].alias(f.name) for i, f in enumerate(extra)])
