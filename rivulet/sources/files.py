"""Scans and sinks of sample files."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet import schema as S
from rivulet.functions.numbers import to_doubles
from rivulet.functions.text import BLANKS, slug_from_stem, state_name, state_slug, strip, year_from_stem
from rivulet.operators.shaping import bind
from rivulet.session import settings
from rivulet.sources.quoted import BROADCAST_SPLITS, scan_records


#: How a record is cut into cells: doubled quotes, line breaks inside quotes kept as they are.
CELLS = {"escape": '"', "quote": '"', "multiLine": "true", "mode": "PERMISSIVE"}
#: A text that stands for a missing value, with or without white space at its ends.
MISSING = rf"\A[{BLANKS}]*(?:{'|'.join(rf'\Q{text}\E' for text in R.MISSING_TEXTS)})[{BLANKS}]*\z"


def scan_samples_csv(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], origin: bool = False
) -> DataFrame:
    """Sample CSV files with a header each, typed and brought to one column list.

    Files may differ in the number and order of their columns: every cell is placed by the header
    of its own file, matched trimmed and in any case. Columns a file does not have are NULL. The
    header is the first row of a file and names the station code or the location; a file with
    rows whose first row does not raises an error with its path. Quoted cells may hold line
    breaks, and large files are read in many splits all the same (see ``quoted``).
    With ``origin`` a column of that name holds the place of each row (path, block, row), which sorts rows by
    file name and by their order in the file.
    """
    return _scan(spark, paths, columns, origin).drop(*FILE_PARTS)


#: What the name of a file says of its rows; read once for each split.
FILE_PARTS = ["file_stem", "file_slug", "file_year", "file_state"]


def _scan(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], origin: bool) -> DataFrame:
    """The rows of ``scan_samples_csv`` with ``FILE_PARTS``."""
    records, splits = scan_records(spark, paths)
    width = F.max(F.length("header") - F.length(F.replace(F.col("header"), F.lit(","))) + 1)
    widest, count = splits.agg(width, F.count("*")).first()  # the number of cells of the widest header, and of splits
    cells = [f"c{i}" for i in range(widest or 1)]
    schema = ", ".join(f"{c} string" for c in cells)

    def cut(df: DataFrame, text: str) -> DataFrame:
        row = bind(df, _row=F.from_csv(F.col(text), schema, CELLS))
        return row.select(*df.columns, F.array(*[F.col(f"_row.{c}") for c in cells]).alias("cells"))

    # Where in the rows of its file each wanted column stands (0: nowhere): one small row per split.
    named = cut(splits, "header").select("split", "path", F.transform("cells", lambda c: F.lower(strip(c))).alias("names"))
    known = F.array_contains("names", "monitoring_location") | F.array_contains("names", "stn_code")
    lost = F.raise_error(F.concat(F.lit("no header in "), F.col("path"))).cast("array<int>")
    at = F.array(*[F.coalesce(F.array_position("names", F.lit(name)), F.lit(0)).cast("int") for name in columns])
    headers = with_file_parts(named.select("split", "path", F.when(F.coalesce(known, F.lit(False)), at).otherwise(lost).alias("at")))
    headers = headers.withColumn("file_state", state_name(F.col("file_slug")))
    # Spark sizes the small files of the splits far above their rows, and would shuffle all records instead.
    placed = cut(records, "record").join(F.broadcast(headers) if count <= BROADCAST_SPLITS else headers, "split")

    kinds = {name: S.column_type(name).simpleString() for name in columns}
    numbers = [name for name in columns if kinds[name] in ("double", "int")]

    def cell(name: str) -> Column:
        place = F.get("at", F.lit(columns.index(name)))
        return F.when(place > 0, F.get("cells", place - 1))

    def typed(name: str) -> Column:
        if name in numbers:
            number = F.get("_numbers", F.lit(numbers.index(name)))
            return number if kinds[name] == "double" else number.try_cast("int")
        value = F.when(~F.rlike(cell(name), F.lit(MISSING)), cell(name))
        return value.try_cast("boolean") if kinds[name] == "boolean" else value

    # Numbers are parsed as one array: a parser for each column grows into a method that the JVM does not compile.
    rows = bind(placed, _numbers=to_doubles(F.array(*[cell(name) for name in numbers]).cast("array<string>")))
    place = [F.struct("path", "block", "row").alias("origin")] if origin else []
    return rows.select("path", *[typed(name).alias(name) for name in columns], *place, *FILE_PARTS)


def scan_parquet_origin(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet files with the place of each row as ``origin``: (path, block, row), sorted as in ``scan_samples_csv``."""
    meta = F.col("_metadata")
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths)).select("*", F.struct(
        meta["file_path"].alias("path"), F.lit(0).cast("bigint").alias("block"), meta["row_index"].alias("row")).alias("origin"))


def with_file_parts(df: DataFrame) -> DataFrame:
    """Adds stem, slug and year taken from the file name or a 'stem=' folder in ``path``."""
    stem = F.coalesce(
        F.nullif(F.regexp_extract("path", r"stem=([^/]+)/", 1), F.lit("")),
        F.regexp_extract("path", r"([^/]+)\.[A-Za-z]+$", 1),
    )
    return df.withColumn("file_stem", stem).withColumns({
        "file_slug": slug_from_stem(F.col("file_stem")),
        "file_year": year_from_stem(F.col("file_stem")),
    })


def scan_samples_multi(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str],
    exclude_years: Iterable[int] = (), cleaned: bool = False, origin: bool = False,
) -> DataFrame:
    """All yearly sample files of a folder.

    State and year come from the file stem. Files without a year in the stem, training files and
    excluded years are left out; ``cleaned`` chooses between '<stem>' and '<stem>_clean' files.
    """
    rows = _scan(spark, paths, columns, origin)
    is_clean = F.endswith("file_stem", F.lit("_clean"))
    kept = rows.filter(
        F.col("file_year").isNotNull()
        & ~F.contains("file_stem", F.lit("train"))
        & (is_clean if cleaned else ~is_clean)
    )
    excluded = list(exclude_years)
    if excluded:
        kept = kept.filter(~F.col("file_year").isin(excluded))
    return kept


def scan_year_partitions(
    spark: SparkSession, root: str, pattern: str = "*.pdf", exclude_years: Iterable[int] = (),
    fallback: str = "*.html",
) -> DataFrame:
    """Report files under folders named by year: path, year, modification time and length.

    A year whose folder holds no file of the pattern gives those of the fallback pattern. Only file
    listings are read; the contents are not selected.
    """
    first = _year_files(spark, root, pattern, exclude_years)
    if not fallback or fallback == pattern:
        return first
    other = _year_files(spark, root, fallback, exclude_years)
    return first.unionByName(other.join(first.select("year").distinct(), "year", "left_anti"))


def _year_files(spark: SparkSession, root: str, pattern: str, exclude_years: Iterable[int]) -> DataFrame:
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).load(root)
        .select("path", "modificationTime", "length")
        .withColumn("year", F.regexp_extract("path", r"/(?:year=)?(\d{4})/[^/]+$", 1).try_cast("int"))
        .filter(F.col("year").isNotNull())
    )
    excluded = list(exclude_years)
    return files.filter(~F.col("year").isin(excluded)) if excluded else files


def scan_text_whole(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Every text file as one row (source, text)."""
    return spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("source"), F.col("value").alias("text")
    )


def scan_json_map(spark: SparkSession, path: str, schema: str, key_names: Sequence[str],
                  separator: str) -> DataFrame:
    """Cache file holding one JSON map: one row per entry, its key split into columns."""
    entries = spark.read.text(path, wholetext=True).select(
        F.explode(F.from_json("value", schema))
    )
    parts = F.split("key", separator)
    return entries.select(
        *[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(key_names)], "value.*"
    )


def scan_page_rows(spark: SparkSession, path: str) -> DataFrame:
    """Decoded page rows (see schema.PAGE_ROW)."""
    return spark.read.schema(S.PAGE_ROW).parquet(path)


def with_slug(df: DataFrame) -> DataFrame:
    return df.withColumn("state_slug", state_slug(F.col("state")))


def sink_per_state_year(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One folder per state and year.

    The rebalance hint gathers the rows of a folder and splits a folder that holds far more rows
    than the others over several tasks and files.
    """
    rows = df if "state_slug" in df.columns else with_slug(df)
    writer = rows.hint("rebalance", "state_slug", "year").write.partitionBy("state_slug", "year")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.mode("errorifexists").format(fmt).save(path)


#: Rows of a compressed file, which is read as one split.
FILE_ROWS = 500_000
#: Shuffle files go once the rows are written, not when the driver happens to collect its garbage; rows of a few
#: folders are written without a sort.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": "32"}


def _write_by_stem(df: DataFrame, path: str, compression: str) -> None:
    with settings(df.sparkSession, WRITING):
        (df.write.partitionBy("stem").option("header", True).option("escape", '"').option("compression", compression)
         .option("maxRecordsPerFile", FILE_ROWS).mode("errorifexists").csv(path))


def sink_state_year_csv(df: DataFrame, path: str, suffix: str = "", dealt: bool = False,
                        compression: str = "gzip") -> None:
    """CSV files under 'stem=<state>_<year><suffix>' folders, readable by scan_samples_multi.

    ``dealt``: the rows come rebalanced by state and year already, so they are not shuffled again.
    """
    stem = F.concat(state_slug(F.col("state")), F.lit("_"), F.col("year").cast("string"),
                    F.lit(suffix))
    rows = df.withColumn("stem", stem)
    _write_by_stem(rows if dealt else rows.hint("rebalance", "stem"), path, compression)


def sink_csv_flat(df: DataFrame, path: str) -> None:
    """CSV export with a header and doubled quotes."""
    (df.write.option("header", True).option("escape", '"').option("quote", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .mode("errorifexists").csv(path))


def sink_json_summary(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def rescore_files(spark: SparkSession, paths: str | Sequence[str], out: str,
                  columns: Sequence[str], compression: str = "gzip") -> None:
    """Recomputes the 0-10 score of sample files into a new folder; the input stays.

    Rows of a file share their stem, so a task writes a file for each one it reads, and no row is shuffled.
    """
    from rivulet.operators.score import score_10

    rows = scan_samples_multi(spark, paths, [c for c in columns if c != "pollution_score"])
    scored = score_10(rows).drop("path", "file_slug", "file_year", "file_state")
    _write_by_stem(scored.withColumnRenamed("file_stem", "stem"), out, compression)


def scan_csv_flat(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An export of ``sink_csv_flat`` read back."""
    return (
        spark.read.schema(schema).option("header", True).option("escape", '"')
        .option("multiLine", True).option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    )
