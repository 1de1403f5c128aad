"""Sample and page views over the given star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.shaping import bind

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str, names: bool = True, states: bool = True, dealt: bool = False) -> DataFrame:
    """Yearly station measurements over ``lineitem``.

    The names of stations and states come from unique-key dimensions by left join, so leaving a
    dimension out changes no row. Callers that need only measures switch the joins off and save
    the shuffles they would cost where the dimensions are too large to broadcast.
    With ``dealt`` (and states) rows are rebalanced by state and year, before they grow by what is derived from them.
    """
    l = table(spark, sf_dir, "lineitem")
    part_no, order_no, line = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_linenumber")
    price, year = F.col("l_extendedprice"), F.year("l_shipdate")

    def known(missing: Column, value: Column) -> Column:
        return F.when(~missing, value)

    code = part_no.cast("string")
    columns = [code.alias("stn_code")]
    if dealt:
        l, year = l.withColumn("_year", year), F.col("_year")
    if states:  # one after the other: Spark takes a join of supplier and nation for as large as their product
        l = l.join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
                   F.col("l_suppkey") == F.col("s_suppkey"), "left")
    if names:
        l = l.join(table(spark, sf_dir, "part").select("p_partkey", "p_name"),
                   F.col("l_partkey") == F.col("p_partkey"), "left")
        columns.append(F.concat("p_name", F.lit(" "), code).alias("monitoring_location"))
    columns.append(
        F.when(part_no % 5 == 0, "River").when(part_no % 5 == 1, "Groundwater")
        .when(part_no % 5 == 2, "Pond/Tank").when(part_no % 5 == 3, "Canal")
        .otherwise("Coastal").alias("water_body_type")
    )
    if dealt:
        l = l.hint("rebalance", "s_nationkey", "_year")
    if states:
        l = l.join(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
                   F.col("s_nationkey") == F.col("n_nationkey"), "left")
        columns.append(F.col("n_name").alias("state"))

    fecal = F.when(line <= 2, price / 2000).otherwise(price / 50)
    position = (part_no % 290) * 0.1
    return l.select(
        *columns,
        year.alias("year"),
        F.col("l_shipdate").alias("sampled_at"),
        order_no.alias("k1"), line.alias("k2"), price.alias("k3"),
        (15 + F.col("l_quantity") * 0.4).alias("temperature_avg"),
        known(line == 7, 3 + F.col("l_quantity") * 0.14).alias("do_avg"),
        known(order_no % 11 == 0, F.lit(6.3) + F.col("l_tax") * 30).alias("ph_avg"),
        (price / 20).alias("conductivity_avg"),
        known(line == 3, F.col("l_discount") * 30).alias("bod_avg"),
        known(order_no % 7 == 0, F.col("l_quantity") * 0.25).alias("nitrate_avg"),
        known(line == 5, fecal).alias("fecal_coliform_avg"),
        known(order_no % 5 == 0, price / 10).alias("total_coliform_avg"),
        known(part_no % 13 == 0, 8 + position).alias("latitude"),
        known(part_no % 13 == 0, 68 + position).alias("longitude"),
    )


def station_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stn_code and monitoring_location as in ``samples``, the last name of a station that has several."""
    code = F.col("p_partkey").cast("string")
    named = table(spark, sf_dir, "part").select(
        code.alias("stn_code"), F.concat("p_name", F.lit(" "), code).alias("monitoring_location"))
    return named.groupBy("stn_code").agg(F.max("monitoring_location").alias("monitoring_location"))


# File names, page headings and state spellings of the page-row view (test input).
PAGE_FILES = [
    "WQuality_River-Data-{}.pdf", "Water_creek_marine_seawater_beach_{}.pdf",
    "Water_Quality_Canals_{}.PDF", "Water_pond_tanks_{}.pdf", "NWMP_DATA_{}.pdf",
    "nwmp data {}.pdf", "Water_Quality_Drains_STPs_WTPs_{}.pdf",
]
PAGE_TEXTS = [
    "Water quality of rivers: dissolved oxygen and BOD",
    "Type Water Body, creek and sea", "Ground water: TDS, arsenic", "Barrage and canal data",
    "Drain and STP outlets", "Tank and pond samples", "", "Annual tables",
]
PAGE_STATES = [
    "KARNATAKA", "Tamil  Nadu", "KARN ATAKA", "J & K", "Goalpara", " Kerala", "", "west bengal",
    "State: Uttar Pradesh", "Unknown",
]


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded page rows over ``lineitem``: headings, missing cells and odd state spellings."""
    l = table(spark, sf_dir, "lineitem")
    part_no, order_no, line = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_linenumber")

    def pick(texts: list[str], number: Column) -> Column:
        return F.get(F.array(*[F.lit(t) for t in texts]), (number % len(texts)).cast("int"))

    def whole(value: Column) -> Column:
        return value.cast("int").cast("string")

    year = F.year("l_shipdate")
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    measures = [
        whole(quantity + 10), whole(quantity + 13),
        F.when(line == 2, "-").otherwise(whole(quantity / 10)), whole(quantity / 8),
        F.when(line == 3, "N/A").otherwise(F.lit("7.1")), F.when(order_no % 40 == 0, "29").otherwise("7.9"),
        whole(price / 20), F.when(line == 4, F.lit(None).cast("string")).otherwise(whole(price / 18)),
        F.lit("2.25"), whole(quantity / 5), F.lit(" 1 "), whole(quantity / 7),
        whole(price / 50), F.when(line == 5, "abc").otherwise(whole(price / 40)),
        whole(price), F.lit("1e3"), F.lit("2"), F.when(line != 6, "4"),
    ]
    file_name = F.replace(pick(PAGE_FILES, part_no), F.lit("{}"), year.cast("string"))
    body = F.array(
        whole(part_no), F.concat(F.lit(" Site\n "), part_no.cast("string")),
        F.when(order_no % 3 == 0, "Beach"), pick(PAGE_STATES, F.col("l_suppkey")), *measures,
    )
    heading = F.array(*[F.lit(t) for t in
                        ("Stn Code", "Monitoring Location", "State Name", "Min", "Max")])
    rows = l.select(
        F.concat(F.lit("/reports/"), year.cast("string"), F.lit("/"), file_name).alias("path"),
        file_name.alias("file_name"), year.alias("year"),
        (order_no % 100).cast("int").alias("page_no"),
        pick(PAGE_TEXTS, order_no).alias("page_text"),
        F.lit(1).alias("table_no"), line.cast("int").alias("row_no"),
        F.when(order_no % 20 == 0, heading).otherwise(body).alias("cells"),
        order_no.alias("k1"), line.alias("k2"), price.alias("k3"), part_no.alias("k4"),
    )
    return bind(rows, cells=F.col("cells"))
