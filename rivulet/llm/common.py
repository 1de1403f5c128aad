"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.session import new_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows of one Arrow batch that carries whole texts are handled in slices of about so many bytes.
SLICE_BYTES = 8 << 20


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def held_out(doc_id: Column) -> Column:
    """The fixed test fold: crc32 of the id's digits leaves 2 when divided by 4 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts the lineage for good."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(column: pa.ChunkedArray | pa.Array) -> Iterator[str]:
    """The texts of a column as Python strings, null as empty, a bounded slice at a time."""
    start = 0
    while start < len(column):
        width = max(1, column.nbytes // max(1, len(column)))
        stop = min(len(column), start + max(1, SLICE_BYTES // width))
        for text in column.slice(start, stop - start).to_pylist():
            yield text or ""
        start = stop


def bounded_sample(df: DataFrame, id_column: str, class_column: str, text_column: str,
                   rows: int) -> DataFrame:
    """h (hash of the id), label, text, weight of about ``rows`` rows of each class, or all where there are fewer.

    The share rows / class size becomes a limit for the hash of the id, so the sample is the same on
    every run, and neither texts nor ids are ranked anywhere. Classes are few (the labels of a
    model): one count for each comes to the driver. Of rows that repeat an id one is taken, the
    smallest by label and text, so that a hot id cannot swell the sample. Null labels are left out.
    ``weight`` is the rows of the class for each row taken (1 where all are): weighted, the classes
    of the sample occur as often as in the table, whatever its size.
    """
    held = df.select(F.xxhash64(F.col(id_column)).alias("h"), F.col(class_column).alias("label"),
                     F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    keep, weight = F.lit(False), F.lit(1.0)
    for found in held.where("label is not null").groupBy("label").agg(F.count("*").alias("n")).collect():
        own, taken = F.col("label") == F.lit(found["label"]), min(rows, found["n"])
        top = (1 << 64) * taken // found["n"] - (1 << 63) - 1
        keep = keep | (own & (F.col("h") <= F.lit(top)))
        weight = F.when(own, F.lit(found["n"] / taken)).otherwise(weight)
    one = F.min(F.struct("label", "text")).alias("one")
    return (held.where(keep).groupBy("h").agg(one).select("h", "one.label", "one.text")
            .withColumn("weight", weight))


def as_rows(docs: DataFrame, **keys: Column) -> DataFrame:
    """The rows of ``docs`` as one struct column ``_row`` beside some keys, whatever its columns are called."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*columns).alias("_row"), *[c.alias(n) for n, c in keys.items()])


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a DDL string with bigint, int, double, string, binary, boolean and arrays."""
    plain = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "binary": pa.binary(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
    parts = (part.strip().rsplit(" ", 1) for part in ddl.split(","))
    return pa.schema([(name, plain[kind]) for name, kind in parts])


def batches(schema: pa.Schema, rows: Iterable[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(schema, held)
            held = []
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.record_batch(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
