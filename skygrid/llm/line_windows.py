"""Line dedup: windows of three lines found again anywhere are removed, but for their first occurrence."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygrid.llm.common import appended, raw, without, written

_SPACE = b" \t\r\x0b\x0c"


def windows(text: bytes, width: int) -> tuple[list[bytes], list[int], list[bytes]]:
    """All lines, the places of lines with content, and a 128-bit hash for each ``width`` of those in a row.

    Lines are compared without blanks at either end; blank lines stand outside all windows.
    """
    lines = text.split(b"\n")
    bare = [x.strip(_SPACE) for x in lines]
    place = [k for k, x in enumerate(bare) if x]
    full = [bare[k] for k in place]
    digest = xxhash.xxh3_128_digest
    return lines, place, [digest(b"\n".join(full[k:k + width])) for k in range(len(full) - width + 1)]


def _emit(id_col: str, text_col: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(id_col)).to_pylist()
            doc, hashes = [], []
            for i, text in zip(ids, raw(batch, text_col)):
                found = set(windows(text, width)[2])
                doc += [i] * len(found)
                hashes += found
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(hashes, pa.binary())], ["doc", "window"])

    return run


def _rewrite(text_col: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.schema.get_field_index(text_col)
            nulls = batch.column(col).is_null().to_pylist()
            out, n_lines, n_removed = [], [], []
            for text, null, earlier in zip(raw(batch, text_col), nulls, batch.column(batch.schema.names.index("_earlier")).to_pylist()):
                lines, place, hashes = windows(text, width)
                seen = set(earlier or ())
                gone: set[int] = set()
                for k, h in enumerate(hashes):
                    if h in seen:
                        gone.update(place[k:k + width])
                    seen.add(h)
                out.append(None if null else b"\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text)
                n_lines.append(len(place))
                n_removed.append(len(gone))
            kind = batch.column(col).type
            text = pa.array(out, pa.binary()).cast(kind)
            batch = batch.set_column(col, batch.schema.field(col), text)
            keep = [c for c in batch.schema.names if c != "_earlier"]
            yield appended(batch.select(keep), {"n_lines": pa.array(n_lines, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())})

    return run


def remove_repeated_windows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``docs`` with the lines of repeated windows cut from the text, plus n_lines (with content) and n_removed.

    Every ``width`` consecutive lines form a window. Of equal windows the one first in order of (id, position)
    stays; the lines that any later one covers are removed, overlapping ones together. Each text sends a window
    once, equal windows meet in a combined aggregate, and only windows found in two texts or more go back to
    their texts through joins that adaptive execution may split, so a window of every text has no task of its own.

    Null texts stay null. Texts of fewer than ``width`` lines with content have no windows. A null id comes after all
    others. Rows that share an id count as one document: repeats between them stay, those within each go.
    Input columns n_lines and n_removed are replaced.
    """
    base = without(docs, "n_lines", "n_removed", "_earlier")
    found = written(base.select(F.col(id_col).cast("long").alias(id_col), text_col)
                    .mapInArrow(_emit(id_col, text_col, width), "doc long, window binary"), "line-windows")
    # Null ids sort last: the highest long stands for them inside this step only.
    found = found.withColumn("doc", F.coalesce("doc", F.lit(2**63 - 1)))
    first = found.groupBy("window").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    earlier = (found.join(first, "window").where("doc > first")
               .groupBy("doc").agg(F.collect_set("window").alias("_earlier")))
    joined = (base.withColumn("_doc", F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)))
              .join(earlier.withColumnRenamed("doc", "_doc"), "_doc", "left").drop("_doc"))
    fields = [f for f in joined.schema.fields if f.name != "_earlier"]
    extra = T.StructType.fromDDL("n_lines long, n_removed long")
    return joined.mapInArrow(_rewrite(text_col, width), T.StructType(fields + extra.fields))
