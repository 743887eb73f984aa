"""What several operators share: words, Arrow passes over a table, written intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_dir

#: A word is a longest run of anything but these six ASCII blanks.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The given table, only the columns that are asked for."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder, read again.

    Cuts the lineage: later steps do not repeat what came before, and a lost
    executor costs a read. The file sizes are known, so that Spark decides on
    a broadcast by them and not by an estimate over the plan.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_remainder(column: str, divisor: int) -> Column:
    """crc32 of a column's text, modulo ``divisor``; NULL stays NULL."""
    return F.crc32(F.col(column).cast("string")) % divisor


def bounded_sample(df: DataFrame, most: int, *keys: str) -> DataFrame:
    """At most ``most`` rows of ``df`` in the order of a hash of ``keys``, then of ``keys``.

    Of a larger table the share of rows that is about nine tenths of ``most`` is chosen by
    another hash first, so that all tasks together send about ``most`` rows, however
    many tasks there are.
    """
    rows, whole = df.count(), 1 << 40
    if rows > most:
        share = int(whole * 0.9 * most / rows)
        df = df.where(F.pmod(F.xxhash64(F.lit("share"), *keys), F.lit(whole)) < share)
    return df.orderBy(F.xxhash64(*keys), *keys).limit(most)


#: What this worker process keeps from one task to the next.
_HELD: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], object]) -> object:
    """The object of ``key``, made once per worker process."""
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]


def hold_only(key: tuple | None) -> None:
    """Lets go of what earlier tasks held under other keys: workers outlive their stage."""
    for other in [k for k in _HELD if k != key]:
        del _HELD[other]
    pa.default_memory_pool().release_unused()


def per_batch(
    df: DataFrame,
    schema: str,
    make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict] | dict]],
    holds: tuple | None = None,
) -> DataFrame:
    """Run Python over Arrow batches of ``df``.

    ``make`` is called once per task and returns a function from a batch to
    the columns of the result, as a dict or as an iterator of dicts. ``holds``
    is the key of what it keeps in the worker by :func:`held`.
    """
    def run(batches):
        hold_only(holds)
        step = make()
        for batch in batches:
            made = step(batch)
            for columns in ([made] if isinstance(made, dict) else made):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, type=fields[name])
                     for name, c in columns.items()], names=list(columns))

    spark = df.sparkSession
    empty = spark.createDataFrame([], schema)
    fields = {f.name: _arrow_type(f.dataType) for f in empty.schema.fields}
    return df.mapInArrow(run, empty.schema)


def _arrow_type(spark_type) -> pa.DataType:
    simple = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
    }
    name = spark_type.simpleString()
    if name in simple:
        return simple[name]
    if name.startswith("array<"):
        return pa.list_(_arrow_type(spark_type.elementType))
    return pa.struct([(f.name, _arrow_type(f.dataType)) for f in spark_type.fields])


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; NULL counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def slices(batch: pa.RecordBatch, most: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about ``most`` bytes in all."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends, start, before = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64), 0, 0
    while start < len(ends):
        stop = min(int(np.searchsorted(ends, before + most)) + 1, len(ends))
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])
