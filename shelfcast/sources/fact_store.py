"""The fact table: versioned Parquet partitioned by week and source, with keyed upserts.

An upsert writes its own rows once and, of the touched weeks of each source, the rows that stay, beside
the table's; it takes effect with the version that lists them (see ``versions``): readers keep what they have
opened, and a run that breaks off changes nothing.  A second writer at the same
time is refused when it commits.  Repeating an upsert merges its rows again, into
whatever the table then holds, unless it names the batch of a stream it belongs to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.schemas import FACT_KEY, ITEM, POS_ALL_COLUMNS, POS_FACT, SOURCE, STORE, SUBCATEGORY, WEEK
from shelfcast.sources import versions

PARTITIONS = [WEEK, SOURCE]
SORT = [WEEK, SOURCE, SUBCATEGORY, STORE, ITEM]
MERGE_KEY = [SOURCE, *FACT_KEY]
FILE_ORDER = "_file_order"


#: Versions that stay readable behind the newest.
KEPT_VERSIONS = 10


@dataclass(frozen=True)
class UpsertResult:
    deleted: int
    inserted: int
    #: The batch was part of the table already and has been skipped.
    replayed: bool = False


def _laid_out(df: DataFrame, dealt: bool = False) -> DataFrame:
    """Rebalanced by partition (hot weeks are split, small ones merged) and sorted so
    that subcategory filters skip row groups."""
    return (df if dealt else df.hint("rebalance", *PARTITIONS)).sortWithinPartitions(*SORT)


def append_facts(
    df: DataFrame, path: str, overwrite: bool = False, keep_versions: int = KEPT_VERSIONS, dealt: bool = False
) -> None:
    """Bulk append without looking for duplicates; ``overwrite`` leaves the earlier rows to earlier versions.

    ``dealt`` says that rows of a week come in few tasks already, as when they are read from a fact table: they are
    sorted and written where they are, without an exchange.  It changes the number of files only.
    """
    spark = df.sparkSession
    before = _opened(spark, path)
    added = versions.add_folders(_laid_out(df, dealt), path, PARTITIONS)
    versions.commit(spark, path, before.next(added if overwrite else before.folders + added))
    versions.tidy(spark, path, keep_versions)


def _opened(spark: SparkSession, path: str) -> versions.Version:
    """The newest version, for a writer; a folder of other Parquet files is no table to write to."""
    version = versions.open_version(spark, path)
    if not version.number:
        files, pattern = versions.file_system(spark, f"{path.rstrip('/')}/{WEEK}=*/*.parquet")
        if files.globStatus(pattern):
            raise ValueError(f"{path} has no versions: append its rows to a new table")
    return version


def read_facts(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or that of a number; the frame keeps it whatever is written later."""
    return versions.read(spark, path, POS_FACT, version)


def read_pos_all(spark: SparkSession, path: str) -> DataFrame:
    """The unified view of a stored table.

    Both facts live in one table, so the view is a single scan; a filter on the
    source prunes partitions instead of choosing a branch of a union.
    """
    return read_facts(spark, path).select(POS_ALL_COLUMNS)


def anti_join_keys(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Base rows whose key is not in the delta; NULL keys match nothing."""
    return base.join(delta.select(keys).distinct(), keys, "left_anti")


def upsert_facts(base: DataFrame, delta: DataFrame, keys: list[str] = MERGE_KEY) -> DataFrame:
    """Replace base rows by key; duplicates within the delta are all kept."""
    return anti_join_keys(base, delta, keys).unionByName(delta)


def keep_latest_file(delta: DataFrame, keys: list[str] = MERGE_KEY) -> DataFrame:
    """Per key the rows of the last file that has it.

    The newest file per key is aggregated and joined back: unlike a window this
    combines before the shuffle and lets a heavily repeated key be split.
    """
    newest = delta.groupBy(keys).agg(F.max(FILE_ORDER).alias(FILE_ORDER))
    return delta.join(newest, [*keys, FILE_ORDER], "inner").drop(FILE_ORDER)


def _settled(spark: SparkSession, path: str, folders, order: T.StructField):
    """Folders in which each key has the rows of its last file; only weeks that several files have are written again."""
    read = lambda some: versions.read_folders(spark, path, some, T.StructType([*POS_FACT.fields, order]))
    ends = read(folders).groupBy(PARTITIONS).agg(F.min(FILE_ORDER).alias("first"), F.max(FILE_ORDER).alias("last"))
    shared = {"/".join(str(row[name]) for name in PARTITIONS) for row in ends.where("first < last").toLocalIterator()}
    mixed = [entry for entry in folders if entry[0] in shared]
    if not mixed:
        return folders
    latest = versions.add_folders(_laid_out(keep_latest_file(read(mixed))), path, PARTITIONS)
    versions.remove_folders(spark, path, [folder for _, folder in mixed])
    return tuple(entry for entry in folders if entry[0] not in shared) + latest


def stored_weeks(spark: SparkSession, path: str, version: int | None = None) -> list[tuple[int, str]]:
    """Weeks and sources that a version holds, from its manifest alone."""
    labels = {label for label, _ in versions.open_version(spark, path, version).folders}
    return sorted((int(week), source) for week, source in (label.split("/") for label in labels))


def merge_facts(
    spark: SparkSession, path: str, delta: DataFrame, batch: tuple[str, int] | None = None, keep_versions: int = KEPT_VERSIONS
) -> UpsertResult:
    """Upsert ``delta`` into the stored table; rows deleted and inserted.

    The delta is computed once and written where it stays.  With a column FILE_ORDER the rows of a key's last file count.
    ``batch`` names a stream and a number that grows within it.  The version that
    holds the rows holds that number too, so a batch that comes again is skipped
    and cannot undo what others have written since.
    """
    before = _opened(spark, path)
    if before.has(batch):
        return UpsertResult(0, 0, replayed=True)
    added = versions.add_folders(_laid_out(delta), path, PARTITIONS)
    if FILE_ORDER in delta.columns:
        added = _settled(spark, path, added, delta.schema[FILE_ORDER])
    labels = {label for label, _ in added}
    if not labels:
        if batch:
            versions.commit(spark, path, before.next(before.folders, batch))
        return UpsertResult(0, 0)
    touched = [entry for entry in before.folders if entry[0] in labels]
    read = lambda folders: versions.read_folders(spark, path, folders, POS_FACT)
    kept = versions.add_folders(_laid_out(anti_join_keys(read(touched), read(added), MERGE_KEY)), path, PARTITIONS) if touched else ()
    inserted, deleted = read(added).count(), read(touched).count() - read(kept).count()  # from the files' footers
    versions.commit(spark, path, before.next(before.without(labels) + kept + added, batch))
    versions.tidy(spark, path, keep_versions)
    return UpsertResult(deleted, inserted)
