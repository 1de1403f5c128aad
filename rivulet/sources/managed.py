"""Sample tables kept bucketed by station, so that per-station work needs no shuffle of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A bucket this many times the average is one slow task; such tables are read without their buckets.
SKEW = 4.0
SHARE = "rivulet.largest_bucket_share"
#: Rows of a bucket that a task sorts within its memory, and Spark's bound on the number of buckets.
BUCKET_ROWS, MOST_BUCKETS = 400_000, 100_000


def buckets_for(df: DataFrame, least: int = 8) -> int:
    """Number of buckets that holds them at ``BUCKET_ROWS`` however many rows there are; counts the rows."""
    return min(max(least, -(-df.count() // BUCKET_ROWS)), MOST_BUCKETS)


def create_table(df: DataFrame, name: str, key: str = "stn_code", buckets: int = 64, path: str | None = None) -> None:
    """Writes a table bucketed by ``key``; fails where it exists. Without ``path`` it lies in the warehouse.

    Choose ``buckets`` so that one fits a task (``buckets_for``). Rows are laid out by one shuffle on the key; a station with
    very many rows is split over several files of its bucket. The share of the largest bucket is kept
    with the table (one pass over the key column).
    """
    spark = df.sparkSession
    # The write puts rows in buckets itself; the hint only keeps the number of files near that of the buckets:
    # with as many partitions as buckets no task meets rows of more buckets than it must.
    writer = df.hint("rebalance", buckets, key).write.format("parquet").bucketBy(buckets, key)
    (writer if path is None else writer.option("path", path)).mode("errorifexists").saveAsTable(name)
    sizes = spark.table(name).groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("b")).count()
    row = sizes.agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    share = row["most"] / row["all"] if row["all"] else 0.0
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{SHARE}' = '{share}', 'rivulet.buckets' = '{buckets}')")


def read_table(spark: SparkSession, name: str, skew: float = SKEW) -> DataFrame:
    """The table for per-station work: by bucket, or where one bucket is far above the average by plain splits.

    Both give the same rows. By bucket, grouping and joining on the key need no exchange; by plain splits
    a hot station's rows are spread over tasks, which reduce them before an exchange.
    """
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if float(held[SHARE]) * int(held["rivulet.buckets"]) <= skew:
        return spark.table(name)
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == "Location").first()
    return spark.read.schema(spark.table(name).schema).parquet(about["data_type"])


def drop_table(spark: SparkSession, name: str) -> None:
    """Forgets the table; the files of one created with a path stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
