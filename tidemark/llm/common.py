"""What the text operators share: column handling and passes over text in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The separators of words: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Text that one step of a Python pass holds at once, in bytes (one longer text is a step of its own).
STEP_BYTES = 2 << 20


def without(df: DataFrame, names) -> DataFrame:
    """``df`` without the columns that a result is about to add; case does not count."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def text_key(text: str = "text") -> Column:
    """Tells rows that repeat a document number apart, so that a join by it does not mix texts."""
    return F.xxhash64(F.lit("row"), F.col(text))


def two_hashes(value: Column, label: str) -> tuple[Column, Column]:
    """Two independent 64-bit hashes; together they stand for the value."""
    return F.xxhash64(F.lit(label), value), F.xxhash64(value, F.lit(label + "2"), value)


def ascii_lower(value: Column) -> Column:
    return F.translate(value, UPPER, LOWER)


def steps(texts: list[bytes], limit: int = STEP_BYTES) -> Iterator[slice]:
    """Runs of texts that hold about ``limit`` bytes together."""
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text or b"")
        if held and held + size > limit:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(texts):
        yield slice(start, len(texts))


def over_text(
    df: DataFrame,
    function: Callable[[list[bytes]], dict[str, list]],
    result: T.StructType,
    text: str = "text",
    keep: list[str] | None = None,
    extra: list[str] | None = None,
    step_bytes: int = STEP_BYTES,
) -> DataFrame:
    """Add columns that ``function`` derives from whole texts.

    ``function`` gets UTF-8 texts (``b""`` for null), and the lists of the
    ``extra`` columns after it, and returns a list per result column.  Rows stay
    in their partition, columns in ``keep`` (default: all) pass through unread.
    """
    extra = extra or []
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in {n.lower() for n in result.names}]
    carried = df.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
        *[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(extra)],
        F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("t"),
    )
    fields = [T.StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType(fields + list(result.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in result.fields]
        for batch in batches:
            texts = batch.column("t").to_pylist()
            more = [batch.column(f"x{i}") for i in range(len(extra))]
            for part in steps(texts, step_bytes):
                n = part.stop - part.start
                out = function(texts[part], *[c.slice(part.start, n).to_pylist() for c in more])
                columns = [batch.column(f"k{i}").slice(part.start, n) for i in range(len(keep))]
                columns += [pa.array(out[f.name], kind) for f, kind in zip(result.fields, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    done = carried.mapInArrow(run, schema)
    return done.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f"`{n}`") for n in result.names]
    )
