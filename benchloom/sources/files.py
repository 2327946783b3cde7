"""File sources and sinks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import schemas

def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; only a session on one machine that names none gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("the session of a cluster has to name a shared folder in spark.checkpoint.dir")
        base = f"file://{tempfile.mkdtemp(prefix='benchloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- tables -----------------------------------------------------------------------


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON Lines with an explicit schema: no inference pass; a missing key is NULL."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append rows as JSON Lines; NULL fields are written, so keys stay visible."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def append_batch(df: DataFrame, path: str, batch: str) -> None:
    """Write the rows of one batch as JSON Lines; a batch that is written again replaces itself.

    So a job that is repeated, by a driver that was restarted for instance, appends its rows once.
    """
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/batch={batch}")


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches that :func:`append_batch` has written completely."""
    return spark.read.schema(f"{schema}, batch STRING").option("mode", "PERMISSIVE").json(path).drop("batch")


def read_jacoco(spark: SparkSession, path: str) -> DataFrame:
    """JaCoCo CSV reports, columns found by name, with the place of every row."""
    names = [field.split()[0] for field in schemas.JACOCO.split(",")]
    rows = spark.read.option("header", True).csv(path)
    return rows.select(
        names[0],
        *[F.col(n).try_cast("bigint").alias(n) for n in names[1:]],
        F.monotonically_increasing_id().alias("row_no"),
        F.col("_metadata.file_path").alias("path"),
    )


def write_metrics_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


# --- logs -------------------------------------------------------------------------


def read_log_lines(spark: SparkSession, root: str, names: str = "*", key: Column | None = None) -> DataFrame:
    """``path, at, line`` of the log files below a folder, read by as many tasks as the files have splits.

    ``path`` is the file, or what ``key`` makes of ``_metadata``: several files then are one log, in the order of
    their names.  ``at`` orders the lines of a log: file, start of the split, and an id that grows within the split.
    Only ``\\n`` ends a line.
    """
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", names).option("lineSep", "\n").text(root)
    file = F.col("_metadata.file_path")
    at = F.struct(file.alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
    return rows.select((file if key is None else key).alias("path"), at.alias("at"), F.col("value").alias("line"))


def with_line_numbers(lines: DataFrame, keys: Sequence[str] = ("path",), at: str = "at") -> DataFrame:
    """Add ``line_no``, the place of a line in its log from 0.

    The lines of a split are counted, and the counts of the splits before it are added up, so no log is sorted.
    The file is read twice.  Should the second reading cut it elsewhere, the job fails instead of numbering wrongly.
    """
    split = [*keys, "_path", "_start"]
    rows = lines.withColumns({"_path": F.col(at)["path"], "_start": F.col(at)["start"], "_id": F.col(at)["id"]})
    before = Window.partitionBy(*keys).orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*split).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    same = (F.col("_id") >= F.col("_first")) & (F.col("_id") <= F.col("_last"))
    number = F.when(same, F.col("_before") + F.col("_id") - F.col("_first")).otherwise(
        F.raise_error(F.lit("the splits of a log have changed between two readings")).cast("bigint")
    )
    return rows.join(counts, split, "left").select(*lines.columns, number.alias("line_no"))


# --- reports ----------------------------------------------------------------------

# Where each ecosystem leaves its reports, as patterns over the path.
REPORT_PATHS = {
    "java": r"/surefire-reports/(?:.*/)?TEST-[^/]*\.xml$",
    "go": r"/test-results/[^/]*\.(?:json|xml)$|/gotest_results\.jsonl$",
    "rust": r"/test-results/[^/]*\.(?:json|xml)$|/target/nextest/default/junit\.xml$",
    "ruby": r"/test-results/[^/]*\.(?:json|xml)$|/test/reports/[^/]*\.(?:json|xml)$",
    "scala": r"/(?:target|test-output)/(?:.*/)?[^/]*(?:TEST-|(?i:test))[^/]*\.xml$",
    "php": r"/test-results/[^/]*\.(?:json|xml)$|/build/logs/junit\.xml$|/tests/_output/[^/]*\.(?:json|xml)$",
    "kotlin": r"/build/test-results/test/[^/]*\.(?:json|xml)$|/test-results/[^/]*\.(?:json|xml)$",
    "cpp": r"/test-results/[^/]*\.(?:json|xml)$|/build/Testing/[^/]*/Test\.xml$"
    r"|/ctest_results\.xml$|/build/test_detail\.xml$",
    "python": r"/report_pytest\.json$",
    "javascript": r"/test-results\.xml$|/jest-results\.json$",
    "typescript": r"/test-results\.xml$|/jest-results\.json$",
}


# File names of the reports, so that a listing drops all others.
REPORT_NAMES = {
    "java": "TEST-*.xml", "go": "*.{json,xml,jsonl}", "scala": "*.xml", "python": "report_pytest.json",
    "javascript": "{test-results.xml,jest-results.json}", "typescript": "{test-results.xml,jest-results.json}",
}


def report_names(language: str) -> str:
    return REPORT_NAMES.get(language, "*.{json,xml}")


def is_report(path: Column, language: str) -> Column:
    return path.rlike(REPORT_PATHS[language])


def discover_reports(spark: SparkSession, root: str, language: str) -> DataFrame:
    """``path, text`` of the report files below a folder, each once.

    Files of other names are dropped while folders are listed; the folders in the path
    are a predicate on file metadata, so no other file is opened.
    """
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", report_names(language))
        .option("wholetext", True)
        .text(root)
    )
    return files.where(is_report(F.col("_metadata.file_path"), language)).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


# Where a Scala run leaves its reports, as a pattern over the path below the folder of the run.
SCALA_RUN_PATH = r"^(?:(?:target|test-output)/(?:.*/)?)?[^/]*(?:TEST-|(?i:test))[^/]*\.xml$"


def list_files(spark: SparkSession, root: str, names: str = "*") -> DataFrame:
    """``path`` of the files below a folder; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names).load(root)
    return files.select("path")


def deepest_root(paths: DataFrame, roots: DataFrame, path: str = "path") -> DataFrame:
    """``path, root``: the longest of the ``root`` folders that a path lies in; paths outside of all roots are left out.

    Every folder above a path is a row, so the longest prefix is an equi join and a maximum.
    """
    parts = F.split(path, "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    prefixes = paths.select(path).distinct().select(path, F.explode(above).alias("root"))
    found = prefixes.join(roots.select(F.rtrim(F.col("root"), F.lit("/")).alias("root")).distinct(), "root")
    return found.groupBy(path).agg(F.max_by("root", F.length("root")).alias("root"))


def discover_run_reports(spark: SparkSession, top: str, language: str, marker: str) -> DataFrame:
    """``run, path, text`` of the reports of all runs below a folder.

    A run is a folder that holds a file ``marker``; a report belongs to the deepest run that it lies in.  For
    Scala this also finds reports that lie directly in the folder of a run.
    """
    roots = list_files(spark, top, marker).select(F.regexp_replace("path", "/[^/]*$", "").alias("root"))
    names = report_names(language)
    placed = deepest_root(list_files(spark, top, names), roots)
    if language == "scala":
        wanted = F.substring(F.col("path"), F.length("root") + 2, F.length("path")).rlike(SCALA_RUN_PATH)
    else:
        wanted = is_report(F.col("path"), language)
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", names).option("wholetext", True).text(top)
    # the two readers write the scheme of a local path differently
    plain = lambda path: F.regexp_replace(path, "^file:/+", "file:/")
    texts = texts.select(plain(F.col("_metadata.file_path")).alias("_plain"), F.col("value").alias("text"))
    chosen = placed.where(wanted).select(F.col("root").alias("run"), "path", plain(F.col("path")).alias("_plain"))
    return texts.join(chosen, "_plain").select("run", "path", "text")


def with_run_id(reports: DataFrame, pattern: str, path: str = "path") -> DataFrame:
    """The run id of a report, taken from its path by the first group of a pattern."""
    return reports.withColumn("run_id", F.regexp_extract(path, pattern, 1))


def unprocessed(items: DataFrame, processed_path: str, keys: Sequence[str], schema: str) -> DataFrame:
    """Items that no earlier run has written to ``processed_path``."""
    from ..operators.collect import pending

    return pending(items, read_jsonl(items.sparkSession, processed_path, schema), keys)
