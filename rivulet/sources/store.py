"""A keyed table on disk that grows by small batches: only the hash buckets a batch touches are rewritten.

``settings`` holds keys, number of buckets and schema; ``data/<version>/bucket=<b>`` the rows of a
bucket; ``pointers/n=<n>`` which version each touched bucket has from batch n on. No file is ever
changed. A batch counts once its pointer file exists, a single file that Spark moves into place
when its job is over; before that, readers see the state without it, and a batch that was cut off is simply given again. One
writer at a time.

A store that is not ``unique`` holds any number of rows under a key (the chunks of a source, the
stations of a year); a batch then replaces all rows of the keys it names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "bucket int, version string"


def create_store(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                 buckets: int = 64, unique: bool = True) -> None:
    """An empty store; fails where one exists. Choose ``buckets`` so that one is well below a GB."""
    missing = [k for k in keys if k not in schema.names]
    if missing or not keys:
        raise ValueError(f"keys must be columns of the store: {missing}")
    if "bucket" in schema.names or not 1 <= buckets <= 10_000:
        raise ValueError("no column may be named bucket, and there are 1 to 10,000 buckets")
    _point(spark, path, 0, [])
    settings = json.dumps({"keys": list(keys), "buckets": buckets, "schema": schema.json(), "unique": unique})
    spark.range(1).select(F.lit(settings).alias("value")).coalesce(1).write.text(f"{path}/settings")


def _settings(spark: SparkSession, path: str) -> tuple[list[str], int, T.StructType, bool]:
    held = json.loads(spark.read.text(f"{path}/settings").first()[0])
    return (held["keys"], held["buckets"], T.StructType.fromJson(json.loads(held["schema"])),
            held.get("unique", True))


def _point(spark: SparkSession, path: str, number: int, rows: list[tuple[int, str | None]]) -> None:
    spark.createDataFrame(rows, POINTER).coalesce(1).write.json(f"{path}/pointers/n={number}")


def _current(spark: SparkSession, path: str) -> tuple[int, dict[int, str]]:
    """Number of the last batch and the version of every bucket with rows; at most one row a bucket is collected."""
    pointers = spark.read.schema(f"{POINTER}, n int").json(f"{path}/pointers")
    rows = pointers.groupBy("bucket").agg(F.max(F.struct("n", "version")).alias("last")).collect()
    return (max((r["last"]["n"] for r in rows), default=0),
            {r["bucket"]: r["last"]["version"] for r in rows if r["last"]["version"]})


def last_batch(spark: SparkSession, path: str) -> int:
    """Number of the last batch that counts; 0 for an empty store."""
    return _current(spark, path)[0]


def _rows(spark: SparkSession, path: str, schema: T.StructType, versions: dict[int, str]) -> DataFrame:
    folders = [f"{path}/data/{version}/bucket={bucket}" for bucket, version in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the store as of now; later batches do not change a table that was read."""
    schema = _settings(spark, path)[2]
    return _rows(spark, path, schema, _current(spark, path)[1])


def prepare_upsert(spark: SparkSession, path: str, new: DataFrame,
                   gone: DataFrame | None = None) -> tuple[int, list[tuple[int, str | None]]]:
    """Writes the touched buckets with the batch in them; nothing of it shows until ``commit_upsert``.

    The batch and ``gone`` are computed once. All rows of the keys in ``gone`` leave the store too. In a
    unique store the batch must hold a key once at most (``caches.newest_per_key`` sees to that, else this
    fails); null keys equal null keys. Columns of the store that the batch lacks become null, unknown ones are refused.
    """
    keys, buckets, schema, unique = _settings(spark, path)
    unknown = [c for c in new.columns if c not in schema.names]
    if unknown or any(k not in new.columns for k in keys):
        raise ValueError(f"the batch must have the keys {keys} and no unknown columns: {unknown}")
    number, versions = _current(spark, path)
    version = uuid.uuid4().hex
    with_bucket = T.StructType([*schema, T.StructField("bucket", T.IntegerType())])
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def written(df: DataFrame, name: str, names: Sequence[str]) -> DataFrame:
        shape = T.StructType([f for f in with_bucket if f.name in (*names, "bucket")])
        df.withColumn("bucket", bucket).write.parquet(f"{path}/{name}/{version}")
        return spark.read.schema(shape).parquet(f"{path}/{name}/{version}")

    batch = written(new.select(*(
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in new.columns
        else F.lit(None).cast(f.dataType).alias(f.name) for f in schema)), "batches", schema.names)
    leaving = batch.select(*keys, "bucket")
    if gone is not None:
        named = gone.select(*(F.col(k).cast(schema[k].dataType).alias(k) for k in keys)).distinct()
        leaving = leaving.unionByName(written(named, "gone", keys).select(*keys, "bucket"))
    if unique:
        counts = batch.groupBy("bucket").agg(
            F.count("*").alias("n"), F.countDistinct(F.struct(*keys)).alias("d")).filter("n <> d")
        if not counts.isEmpty():
            raise ValueError("the batch holds a key more than once")
    else:
        leaving = leaving.distinct()
    touched = [r["bucket"] for r in leaving.select("bucket").distinct().collect()]
    if not touched:
        return number, []
    old = _rows(spark, path, schema, {b: versions[b] for b in touched if b in versions})
    same = [old[k].eqNullSafe(F.col(f"_new_{k}")) for k in keys]
    kept = old.join(leaving.select(*(F.col(k).alias(f"_new_{k}") for k in keys)), same, "left_anti")
    # Rebalance splits a bucket that one key fills over several files; a plain repartition would give it to one task.
    (kept.withColumn("bucket", bucket).unionByName(batch).hint("rebalance", "bucket")
     .write.partitionBy("bucket").parquet(f"{path}/data/{version}"))
    filled = {r["bucket"] for r in spark.read.schema(with_bucket).parquet(
        f"{path}/data/{version}").select("bucket").distinct().collect()}
    return number + 1, [(b, version if b in filled else None) for b in touched]


def commit_upsert(spark: SparkSession, path: str, prepared: tuple[int, list[tuple[int, str | None]]]) -> None:
    """Makes a prepared batch visible; fails where another batch was committed in between."""
    number, rows = prepared
    if rows:
        _point(spark, path, number, rows)


def upsert(spark: SparkSession, path: str, new: DataFrame, gone: DataFrame | None = None) -> None:
    """Adds a batch: its entries replace those with the same key, and those with keys in ``gone`` leave."""
    commit_upsert(spark, path, prepare_upsert(spark, path, new, gone))
