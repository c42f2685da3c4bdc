"""What the operators of this folder share: table access, cut lineage, words, row streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrid.session import shared_dir

# Words as runs of anything but ASCII white space (Java pattern of one separator run).
SPACE_RUN = "[ \\t-\\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back: lineage ends here, on storage all executors see."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add: added columns win, as in ``withColumn``."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def n_words(text: Column | str) -> Column:
    """Words of a text as a long; null counts as no text."""
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")),
                          F.lit("[^ \\t-\\r]+")).cast("long")


def raw(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes, null as no bytes. Bytes need no decoding and split on ASCII space only."""
    col = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in col.cast(pa.binary() if pa.types.is_string(col.type) else pa.large_binary()).to_pylist()]


def map_rows(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             fields: str | T.StructType) -> DataFrame:
    """``mapInArrow`` keeping its input's columns in front of ``fields``; ``fn`` appends the new columns."""
    extra = T.StructType.fromDDL(fields) if isinstance(fields, str) else fields
    base = without(df, *extra.fieldNames())
    return base.mapInArrow(fn, T.StructType(base.schema.fields + extra.fields))


def appended(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(batch.columns + list(columns.values()), names=batch.schema.names + list(columns))


# A filter of ids has a fixed size, whatever it holds; it lets every id pass that is in it, and a few others.
SPOT_BITS = 26


def spot(column: Column) -> Column:
    """The place of a value in a filter."""
    return F.pmod(F.xxhash64(column), F.lit(1 << SPOT_BITS))


def spot_filter(ids: DataFrame, column: str) -> np.ndarray:
    """Bits of all values of a column, gathered as bitmaps of a bounded total size."""
    at = spot(F.col(column)) + 1
    found = ids.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bits = np.zeros(1 << (SPOT_BITS - 3), np.uint8)
    for r in found.toLocalIterator():
        part = np.frombuffer(r["bits"], np.uint8)
        bits[(r["bucket"] - 1) * len(part):r["bucket"] * len(part)] = part
    return bits


def passing(batch: pa.RecordBatch, name: str, bits: np.ndarray) -> pa.RecordBatch:
    """Rows whose spot, column ``name``, is in the filter."""
    at = batch.column(batch.schema.names.index(name)).to_numpy(zero_copy_only=False)
    return batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
