"""A kept chunk store that reads a source again only where its pages have changed.

``digests`` remembers a digest of every source's pages and of the chunk sizes, ``chunks`` holds the
chunks; both are keyed stores (``sources.store``). Chunks are committed before digests: a run cut off in between leaves the
old digests, so the next one reads the same sources again and ends in the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.digests import digest_per
from rivulet.operators.knowledge import CHUNK_OVERLAP, CHUNK_SIZE, chunk_ids, chunk_pages
from rivulet.session import new_path
from rivulet.sources import store

CHUNKS = "source string, chunk_index int, document string, id string, batch int"
DIGESTS = "source string, digest string"


def create_chunk_store(spark: SparkSession, path: str, buckets: int = 64) -> None:
    store.create_store(spark, f"{path}/chunks", T.StructType.fromDDL(CHUNKS), ["source"], buckets, unique=False)
    store.create_store(spark, f"{path}/digests", T.StructType.fromDDL(DIGESTS), ["source"], buckets)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """All chunks as of now; ``batch`` is the number of the run that wrote them."""
    return store.read_store(spark, f"{path}/chunks")


def changed_sources(spark: SparkSession, path: str, pages: DataFrame, page: str, text: str = "text",
                    source: str = "source", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """(source, digest) of the sources that are new or whose pages differ from the stored ones.

    The order of rows does not count, page numbers do. Pages without a source are left out.
    """
    named = pages.filter(F.col(source).isNotNull()).select(
        F.col(source).cast("string").alias("source"), F.col(page).alias("_page"), F.col(text).alias("_text"))
    found = digest_per(named, ["source"], ["_page", "_text"]).select(
        "source", F.concat_ws(":", "digest", F.lit(size), F.lit(overlap)).alias("digest"))
    known = store.read_store(spark, f"{path}/digests").withColumnRenamed("digest", "_known")
    return found.join(known, "source", "left").filter(~F.col("digest").eqNullSafe(F.col("_known"))).drop("_known")


def ingest_changed(spark: SparkSession, path: str, pages: DataFrame, page: str, text: str = "text",
                   source: str = "source", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> int:
    """Brings the store up to the given pages and returns how many sources were read again.

    Every source must be given whole. Unchanged sources are neither cut nor written, and where none
    has changed the store is not touched at all. A source whose pages no longer hold words loses its
    chunks; a source that is not given keeps them.
    """
    found = new_path(spark, "changed-sources")
    changed_sources(spark, path, pages, page, text, source, size, overlap).write.parquet(found)
    changed = spark.read.schema(DIGESTS).parquet(found)
    n = changed.count()
    if n:
        batch = store.last_batch(spark, f"{path}/digests") + 1
        again = pages.select(F.col(source).cast("string").alias("source"), F.col(page).alias("_page"),
                             F.col(text).alias("_text")).join(changed, "source", "left_semi")
        chunks = chunk_ids(chunk_pages(again, "source", "_page", "_text", size, overlap))
        store.upsert(spark, f"{path}/chunks", chunks.withColumn("batch", F.lit(batch)), changed)
        store.upsert(spark, f"{path}/digests", changed)
    return n
