"""Document sources: JSON lines (strict and lenient), results of earlier jobs, JDBC tables, memory, nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.operators.cutting import cut

DOCUMENT = (
    "document_id string, version string, original_text string, cleaned_text string, cleaned_title string, cleaned_excerpt string, cleaned_author string, cleaned_publication_date string, "
    "cleaned_revision_date string, cleaned_source_url string, cleaned_categories array<string>, cleaned_tags array<string>, cleaned_word_count int, cleaned_publisher string, temporal_metadata string, "
    "job_id string, processed_at string"
)
NEWEST, ROWS = 5, 10_000


def json_lines(spark: SparkSession, path: str, schema: str = DOCUMENT) -> DataFrame:
    """Strict: a line that is no JSON object fails the read; blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def json_lines_lenient(spark: SparkSession, path: str, schema: str = DOCUMENT) -> tuple[DataFrame, DataFrame]:
    """Rows that could be read, and the raw text of those that could not."""
    read = cut(spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path))
    return read.where("_corrupt IS NULL").drop("_corrupt"), read.where("_corrupt IS NOT NULL").select("_corrupt")


def until_first_bad(spark: SparkSession, paths: str | list[str], schema: str = DOCUMENT) -> DataFrame:
    """Lenient by file: the rows of each file before its first line that is no JSON object; blank lines are skipped.

    A line's place is the block of its file and its order in the task that reads the block, so large files are read by many
    tasks; what meets is one place for each file that has a bad line.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("at"))
    row = F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    read = cut(lines.where(F.trim("value") != "").withColumn("row", row))
    bad = F.col("row").isNull() | F.col("row._corrupt").isNotNull() | ~F.ltrim("value").startswith("{")
    first = read.where(bad).groupBy(F.col("file").alias("of")).agg(F.min("at").alias("first"))
    kept = read.join(first, F.col("file") == F.col("of"), "left").where(F.col("first").isNull() | (F.col("at") < F.col("first")))
    return kept.select("row.*").drop("_corrupt")


def newest_files(spark: SparkSession, folder: str, pattern: str, most: int = NEWEST) -> list[str]:
    """Paths of the newest files, newest first; a bounded listing, by modification time, then by path."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return [r["path"] for r in listed.select("path", "modificationTime").orderBy(F.desc("modificationTime"), "path").limit(most).collect()]


def of_job(df: DataFrame, job_id: str) -> DataFrame:
    """Rows of the job, and those that name none."""
    return df.where((F.col("job_id") == job_id) | (F.coalesce("job_id", F.lit("")) == ""))


def files_of_job(spark: SparkSession, folder: str, job_id: str, patterns: tuple[str, ...] = ("processed_*.jsonl", "*.jsonl"), schema: str = DOCUMENT) -> DataFrame:
    """Documents of a job from the newest files of each pattern, each path once and up to its first bad line."""
    paths = list(dict.fromkeys(p for pattern in patterns for p in newest_files(spark, folder, pattern)))
    if not paths:
        return nothing(spark, schema)
    return of_job(until_first_bad(spark, paths, schema), job_id)


def latest(table: DataFrame, order: str, ties: tuple[str, ...] = (), most: int = ROWS) -> DataFrame:
    """The latest rows; of equal times, the largest in the columns ``ties``, so that reruns agree."""
    return table.orderBy(F.desc(order), *[F.desc(c) for c in ties]).limit(most)


def recent_rows(table: DataFrame, job_id: str, order: str = "processed_at", most: int = ROWS) -> DataFrame:
    """The latest rows of a job or batch, as the store's query returns them."""
    ties = tuple(c for c in ("document_id",) if c in table.columns)
    return latest(table.where((F.col("job_id") == job_id) | (F.col("batch_id") == job_id)), order, ties, most)


def jdbc_rows(spark: SparkSession, url: str, table: str, job_id: str, properties: dict, most: int = ROWS) -> DataFrame:
    """Like ``recent_rows`` from a database; filter, order and limit are pushed down."""
    return recent_rows(spark.read.jdbc(url, table, properties=properties), job_id, most=most)


def first_with_rows(*frames: DataFrame) -> DataFrame:
    """The first source that has any row, else the last."""
    return next((f for f in frames[:-1] if not f.isEmpty()), frames[-1])


def in_memory(spark: SparkSession, rows: list, schema: str = DOCUMENT) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def nothing(spark: SparkSession, schema: str = DOCUMENT) -> DataFrame:
    return spark.createDataFrame([], schema)
