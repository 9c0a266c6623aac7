"""What several operators share: table access, hold-out folds, hot-key lookups and text chunks for numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger.session import stage
from promoledger.sources.storage import delete_folder

SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def hash_share(*columns: str) -> Column:
    """A number from 0 to 1 that the values fix and that is spread evenly over different values."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / F.lit(1 << 40)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def spread_lookup(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join whose left side may have hot keys: ``small`` has one row a key and is repeated once per salt.

    The hot key's rows go to as many tasks as there are salts, whatever AQE does.
    A row's salt is a hash of the row, so that a task that runs again after an
    executor is lost deals the same rows to the same places. ``small`` should be
    what is left after aggregation and filtering.
    """
    salted = small.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    own = [F.col(f"`{f.name}`") for f in big.schema.fields if _hashable(f.dataType)]
    keyed = big.withColumn("__salt", F.pmod(F.xxhash64(F.lit("salt"), *own), F.lit(SALTS)).cast("int"))
    return keyed.join(salted, [*on, "__salt"], how).drop("__salt")


def with_outputs(df: DataFrame, outputs: Sequence[str]) -> list[str]:
    """Columns of ``df`` without those an operator is about to add; the operator's own win."""
    taken = {c.lower() for c in outputs}
    return [f"`{c}`" for c in df.columns if c.lower() not in taken]


class Scratch:
    """The tables that one computation writes on its way; they go once its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        found, path = stage(df, label)
        self.paths.append(path)
        return found

    def result(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` written; all other tables are deleted."""
        found, _ = stage(df, label)
        self.clear()
        return found

    def clear(self) -> None:
        for path in self.paths:
            delete_folder(self.spark, path)
        self.paths = []


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow string column on end, and where each begins; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_groups(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``most`` bytes: (first row, row after the last, bytes, offsets).

    Keeps numpy's working arrays small; a longer text comes alone.
    """
    data, offsets = utf8_parts(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The runs of equal keys of rows sorted by them, each as one table; keeps one run and one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        change[0] = last is None or tuple(c[0] for c in columns) != last
        starts = np.flatnonzero(change)
        if not len(starts) or starts[0]:
            held.append(batch.slice(0, int(starts[0]) if len(starts) else batch.num_rows))
        for i, start in enumerate(starts):
            if held:
                yield pa.Table.from_batches(held)
            end = int(starts[i + 1]) if i + 1 < len(starts) else batch.num_rows
            held = [batch.slice(int(start), end - int(start))]
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """An Arrow list column of equally long, null-free lists as a two-dimensional array of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1) if rows else np.zeros((0, 1))


def usable_vector(vector: Column, ident: Column) -> Column:
    """Whether a vector takes part: id and vector are there, no component is null, infinite or NaN, not all are zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ident.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))
