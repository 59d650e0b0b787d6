"""Weekly point-of-sale CSV files: reading, validation, conforming, routing."""

from __future__ import annotations

import csv
import logging
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.numeric import integer
from shelfcast.schemas import (
    CATEGORY_A,
    CATEGORY_A_EXTRAS,
    CATEGORY_A_SUBCATEGORIES,
    GENERAL,
    ITEM,
    POS_FACT,
    REQUIRED_COLUMNS,
    SOURCE,
    STORE,
    SUBCATEGORY,
    WEEK,
)
from shelfcast.sources.fact_store import FILE_ORDER, UpsertResult, append_facts, merge_facts
from shelfcast.sources import versions
from shelfcast.sources.versions import file_system

log = logging.getLogger(__name__)

# Texts that count as missing in the input files.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
}
#: Raw text of a line that has not as many fields as the header (a column of reads only).
RAW_LINE = "_raw_line"
FIELDS = "_fields"
REJECTED = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField(WEEK, T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("field_count", T.IntegerType()),
        T.StructField("expected_count", T.IntegerType()),
    ]
)


class MissingColumns(ValueError):
    """A file lacks one of the columns that identify a fact row."""


@dataclass
class LoadResult:
    loaded: list[str] = field(default_factory=list)
    skipped: dict[str, str] = field(default_factory=dict)
    #: Lines with more fields than their file's header, by file; ``read_rejected`` has the lines.
    rejected: dict[str, int] = field(default_factory=dict)
    upserted: UpsertResult | None = None


def require_columns(columns) -> None:
    absent = [c for c in REQUIRED_COLUMNS if c not in columns]
    if absent:
        raise MissingColumns(f"missing required columns: {absent}")


def read_pos_csv(spark: SparkSession, path) -> DataFrame:
    """All-text read of one file, or of several with the same header."""
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    trimmed = raw.toDF(*[c.strip() for c in raw.columns])
    require_columns(trimmed.columns)
    return trimmed


def unique_names(header) -> list[str]:
    """Trimmed column names; a name that comes again gets a number, as no column of ours has."""
    seen: dict[str, int] = {}
    out = []
    for name in (column.strip() for column in header):
        count = seen[name.lower()] = seen.get(name.lower(), -1) + 1
        out.append(f"{name}.{count}" if count else name)
    return out


def read_lines(spark: SparkSession, paths, header) -> DataFrame:
    """All-text rows of files with one header, with RAW_LINE and FIELDS where a line has another number of fields.

    Lines that are too short have NULL in the columns they lack; lines that are too long cannot be told which
    field is surplus, see ``split_rejected``.  Every field is parsed: with pruned columns Spark would not count them.
    """
    names = unique_names(header)
    layout = T.StructType([T.StructField(name, T.StringType()) for name in [*names, RAW_LINE]])
    options = CSV_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_LINE, "columnPruning": False}
    return with_field_count(spark.read.schema(layout).options(**options).csv(paths))


def with_field_count(lines: DataFrame) -> DataFrame:
    """Append FIELDS, the number of fields of a raw line; commas inside quotes do not part fields."""
    bare = F.regexp_replace(RAW_LINE, r'"(?:[^"]|"")*"', "")
    return lines.withColumn(FIELDS, F.when(F.col(RAW_LINE).isNotNull(), F.size(F.split(bare, ","))))


def split_rejected(lines: DataFrame, expected: int) -> tuple[DataFrame, DataFrame]:
    """Rows to load, and lines with more than ``expected`` fields in the layout of REJECTED."""
    surplus = F.coalesce(F.col(FIELDS) > expected, F.lit(False))
    file = F.col("source_file") if "source_file" in lines.columns else F.col("_metadata.file_path").alias("source_file")
    bad = lines.where(surplus).select(
        file, F.col(WEEK), F.col(RAW_LINE).alias("line"),
        F.col(FIELDS).alias("field_count"), F.lit(expected).alias("expected_count"),
    )
    return lines.where(~surplus).drop(RAW_LINE, FIELDS), bad


def rejected_path(path: str) -> str:
    """Where the rejected lines of a fact table's loads are kept."""
    return f"{path.rstrip('/')}__rejected"


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The rejected lines of all loads of the fact table at ``path``."""
    return versions.read(spark, rejected_path(path), REJECTED)


def keep_rejected(lines: DataFrame, path: str) -> dict[str, int]:
    """Add lines to the side table of a fact table; their number by file."""
    spark, side = lines.sparkSession, rejected_path(path)
    before = versions.open_version(spark, side)
    added = versions.add_folders(lines, side)
    if not added:
        return {}
    versions.commit(spark, side, before.next(before.folders + added))
    counts = versions.read_folders(spark, side, added, REJECTED).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    return {row["source_file"]: row["n"] for row in counts.toLocalIterator()}


def any_surplus(seen: Observation) -> bool:
    """Whether the job that read the lines saw one too many fields; True where adaptive execution left the count out."""
    try:
        return bool(seen.get["surplus"])
    except Py4JJavaError:  # an input found empty is cut from the plan, and its count with it
        return True


def observed(lines: DataFrame, expected: int) -> tuple[DataFrame, Observation]:
    """The lines, and how many of them are too long once a job has read them: no pass of its own."""
    seen = Observation()
    return lines.observe(seen, F.count_if(F.col(FIELDS) > expected).alias("surplus")), seen


def route_by_subcategory(df: DataFrame, subcategories=CATEGORY_A_SUBCATEGORIES) -> DataFrame:
    """Tag each row with its fact; an unknown or NULL subcategory is general."""
    is_a = F.coalesce(F.col(SUBCATEGORY).isin([str(s) for s in subcategories]), F.lit(False))
    return df.withColumn(SOURCE, F.when(is_a, F.lit(CATEGORY_A)).otherwise(F.lit(GENERAL)))


def _text(name: str) -> Column:
    value = F.trim(F.col(f"`{name}`").cast("string"))
    return F.when(~value.isin(MISSING_TEXTS), value)


def conform(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Routed rows in the canonical schema.

    Unknown columns go, absent ones are NULL, the extra texts are kept for
    Category A only.  A row without week, store or item fails the job, as a NOT
    NULL column would.  ``keep`` names additional columns to carry along.
    """
    only_a = set(CATEGORY_A_EXTRAS)
    columns = []
    for spec in POS_FACT.fields:
        name = spec.name
        if name not in df.columns:
            value = F.lit(None).cast(spec.dataType)
        elif isinstance(spec.dataType, (T.LongType, T.IntegerType)):
            value = integer(_text(name)).cast(spec.dataType)
        else:
            value = _text(name)
        if name in only_a:
            value = F.when(F.col(SOURCE) == CATEGORY_A, value)
        if name in (WEEK, STORE, ITEM):
            value = F.coalesce(value, F.raise_error(F.lit(f"row without {name}")).cast(spec.dataType))
        columns.append(value.alias(name))
    return df.select(*columns, *keep)


def source_label(file_name: Column, update: bool = False) -> Column:
    """Category named by a file; the catch-all labels differ between load and update."""
    name = F.lower(file_name)
    label = F.when(name.contains("category_a"), F.lit("Category A")).when(
        name.contains("category_d"), F.lit("Category D")
    )
    if update:
        return label.otherwise(F.lit("Mixed"))
    return label.when(name.contains("data"), F.lit("Mixed Categories")).otherwise(F.lit("Unknown"))


def tag_source_file(df: DataFrame, update: bool = False) -> DataFrame:
    """Append ``source_file`` and ``source_category`` of rows read from files."""
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return df.withColumns({"source_file": F.col("_metadata.file_name"), "source_category": source_label(stem, update)})


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The first line of a file, compressed or not, read without a Spark job."""
    files, own = file_system(spark, path)
    jvm = spark.sparkContext._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(own)
    stream = files.open(own)
    try:
        stream = codec.createInputStream(stream) if codec else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(c.strip() for c in next(csv.reader([line.lstrip("\ufeff")]), ())) if line else ()


def _layouts(spark: SparkSession, paths: list[str], result: LoadResult) -> dict[tuple[str, ...], list[str]]:
    """Files by header; missing files and those without the required columns are skipped and reported."""
    found: dict[tuple[str, ...], list[str]] = {}

    def header(path: str):
        try:
            columns = _header(spark, path)
            require_columns(columns)
        except (MissingColumns, Py4JJavaError) as problem:
            return problem
        return columns

    with ThreadPool(16) as pool:
        for path, columns in zip(paths, pool.map(header, paths), strict=True):
            if isinstance(columns, Exception):
                reason = str(columns) if isinstance(columns, MissingColumns) else columns.java_exception.toString()
                log.error("%s: %s", path, reason)
                result.skipped[path] = reason
            else:
                found.setdefault(columns, []).append(path)
                result.loaded.append(path)
    return found


def list_csv_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the CSV files directly in a folder (no file is read)."""
    files, pattern = file_system(spark, f"{folder.rstrip('/')}/*.csv")
    return sorted(status.getPath().toString() for status in files.globStatus(pattern) if status.isFile())


def _files_of(spark: SparkSession, path: str) -> list[str]:
    """The files of a folder; any other path as it is, whether or not it exists."""
    files, own = file_system(spark, path)
    if not files.exists(own) or not files.getFileStatus(own).isDirectory():
        return [path]
    inside = [status.getPath() for status in files.listStatus(own) if status.isFile()]
    return sorted(file.toString() for file in inside if file.getName()[0] not in "._")


def _stacked(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


class _Layouts:
    """The rows of files by header, and what has to be done about lines that are too long once the rows are read."""

    def __init__(self, spark: SparkSession, layouts: dict[tuple[str, ...], list[str]]):
        self.rows: list[DataFrame] = []
        self._parts: list[tuple[DataFrame, Observation]] = []
        for header, files in layouts.items():
            lines, seen = observed(read_lines(spark, files, header), len(header))
            good, _ = split_rejected(lines, len(header))
            self.rows.append(good)
            self._parts.append((split_rejected(read_lines(spark, files, header), len(header))[1], seen))

    def keep_rejected(self, path: str) -> dict[str, int]:
        """Read the layouts with such lines again, for these lines."""
        bad = [lines for lines, seen in self._parts if any_surplus(seen)]
        return keep_rejected(_stacked(bad), path) if bad else {}


def initial_load(spark: SparkSession, folder: str, path: str, clear_first: bool = False) -> LoadResult:
    """Append every CSV file of a folder to the fact table, without deduplication.

    Files that share a header are read by one scan, so the plan grows with the
    number of layouts, not of files.  A file without the required columns is
    skipped and reported; lines with more fields than the header go to a side
    table (see ``read_rejected``) and are counted.
    """
    result = LoadResult()
    layouts = _layouts(spark, list_csv_files(spark, folder), result)
    if layouts:
        parts = _Layouts(spark, layouts)
        append_facts(_stacked([conform(route_by_subcategory(rows)) for rows in parts.rows]), path, overwrite=clear_first)
        result.rejected = parts.keep_rejected(path)
    return result


def _plain(path: Column) -> Column:
    """A file's URI with one slash behind the scheme, whichever way it was written."""
    return F.regexp_replace(path, ":/+", ":/")


def weekly_update(spark: SparkSession, files, path: str) -> LoadResult:
    """Upsert files into the fact table; for equal keys the later file wins.

    All files are merged in one pass, with one scan for each layout.  Missing or
    invalid files are skipped and reported, lines with too many fields as in
    ``initial_load``.  ``files`` is a path or a list of paths; ``upserted`` of the
    result has the rows deleted and inserted.
    """
    given = [files] if isinstance(files, str) else list(files)
    result = LoadResult()
    expanded = [(number, file) for number, path_ in enumerate(given) for file in _files_of(spark, path_)]
    layouts = _layouts(spark, list(dict.fromkeys(file for _, file in expanded)), result)
    if not layouts:
        return result
    qualified = lambda file: file_system(spark, file)[0].makeQualified(file_system(spark, file)[1]).toUri().toString()
    order = spark.createDataFrame([(qualified(file), number) for number, file in expanded if file not in result.skipped], f"_file string, {FILE_ORDER} int")
    order = order.groupBy(_plain(F.col("_file")).alias("_file")).agg(F.max(FILE_ORDER).alias(FILE_ORDER))
    parts = _Layouts(spark, layouts)
    frames = []
    for rows in parts.rows:
        named = rows.withColumn("_file", _plain(F.col("_metadata.file_path"))).join(F.broadcast(order), "_file")  # a row a file
        frames.append(conform(route_by_subcategory(named), keep=(FILE_ORDER,)))
    rows = _stacked(frames)
    result.upserted = merge_facts(spark, path, rows if len(given) > 1 else rows.drop(FILE_ORDER))
    result.rejected = parts.keep_rejected(path)
    return result
