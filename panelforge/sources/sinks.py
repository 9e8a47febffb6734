"""Writers: landing, full replace, keyed upsert, partitioned + clustered layout.

Paths may be any Hadoop URI.  Nothing here goes through the driver but folder
names: every write is a distributed job, beside what it replaces, and a rename
publishes it once it is complete and its checks have passed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelforge.contracts import KEYS
from panelforge.operators.checks import Watch, watch_marked, watch_rows
from panelforge.operators.filters import EmptyInputError
from panelforge.operators.reshape import rename_geography
from panelforge.sources.files import Folder, stored_schema


class SchemaMismatchError(ValueError):
    pass


class DuplicateKeyError(ValueError):
    pass


class MissingTargetError(FileNotFoundError):
    pass


def assert_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Column names, order and types must equal the declared contract."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if got != want:
        raise SchemaMismatchError(f"schema {got} does not match contract {want}")
    return df


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Replace what is stored at ``path`` by what ``write`` puts into the folder it is given.

    The new rows are written beside the old ones, which stay readable until all
    of them are there; two renames then exchange the folders.  A write that
    fails leaves the table as it was.  A driver that dies between the renames
    leaves the old version under ``<path>.old``, which ``restore_folder``, and
    with it the next replacement or read of a target, puts back.  ``write`` may read ``path``.
    """
    table = restore_folder(spark, path)
    new, old = table.new_beside(), table.beside("old")
    try:
        write(new.path)
    except BaseException:
        new.delete()
        raise
    if table.exists():
        table.move_to(old)
    new.move_to(table)
    old.delete()
    spark.catalog.refreshByPath(table.path)
    return path


def restore_folder(spark: SparkSession, path: str) -> Folder:
    """Finish a replacement whose driver died between its renames."""
    table = Folder(spark, path)
    old = table.beside("old")
    if old.exists():
        if table.exists():
            old.delete()
        else:
            old.move_to(table)
    return table


def land_wide(df: DataFrame, path: str, check_input: bool = True) -> str:
    """Land one raw extract: rename the geography column, replace the Parquet
    output, reject empty input.  Returns the path written.  The rows are counted
    while they are written; an empty extract is not published."""
    return replace_counted(rename_geography(df), path, path if check_input else None)


def replace_counted(df: DataFrame, path: str, required: str | None = None) -> str:
    """``replace_sink`` that publishes nothing, and raises, where ``required`` names a table without rows."""
    if required is None:
        return replace_sink(df, path)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))

    def write(folder: str) -> None:
        counted.write.parquet(folder)
        if not seen.get["n"]:
            raise EmptyInputError(f"{required}: no rows")

    return replace_folder(df.sparkSession, path, write)


def replace_sink(df: DataFrame, path: str, schema: StructType | None = None) -> str:
    """Full replace: the whole output is rewritten on every run (idempotent).

    The old rows stay until the new ones are complete (``replace_folder``).
    """
    if schema is not None:
        assert_schema(df, schema)
    return replace_folder(df.sparkSession, path, df.write.parquet)


def init_table(spark: SparkSession, schema: StructType, path: str) -> str:
    """Create an empty typed table, the precondition of ``upsert_sink``."""
    spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)
    return path


def read_target(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a table that a run is about to change; what an earlier run left half done is finished first."""
    if not restore_folder(spark, path).exists():
        raise MissingTargetError(f"upsert target {path} does not exist")
    finish_commit(spark, path)
    return read_written(spark, path, schema) if schema is not None else spark.read.parquet(path)


def save_table(df: DataFrame, name: str, path: str, schema: StructType | None = None) -> str:
    """Full replace of a catalog table of Parquet files at ``path`` (shared storage).

    The files are replaced as by ``replace_sink``; the catalog entry is made
    once and keeps naming the same folder.
    """
    spark = df.sparkSession
    replace_sink(df, path, schema)
    if spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path, source="parquet", schema=df.schema)
    return name


def save_bucketed(df: DataFrame, name: str, path: str, schema: StructType, keys: Sequence[str] = KEYS,
                  buckets: int = 8, partition_by: Sequence[str] = ()) -> str:
    """A catalog table whose files are dealt by ``keys`` and sorted by them.

    Tables with the same keys and bucket count join, aggregate and de-duplicate
    on the keys without a shuffle.  Rows are dealt by the same hash before the
    write, so a bucket is one file per partition.  ``partition_by`` adds
    folders, as for ``year_date``; buckets are then by the other keys, the
    catalog's form of clustering.
    """
    assert_schema(df, schema)
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.format("parquet").mode("overwrite").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return name


@contextmanager
def catalog_names(spark: SparkSession, count: int = 1) -> Iterator[list[str]]:
    """Fresh catalog table names; their entries, not the files they name, go at the end."""
    names = [f"panel_{uuid.uuid4().hex[:12]}" for _ in range(count)]
    try:
        yield names
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def named_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> Iterator[None]:
    """Views by which SQL names the ``tables``; they go at the end.

    A frame that SQL made meanwhile stays valid: it holds the tables, not their
    names.  A view of the session by one of the names would be lost, so that raises.
    """
    taken = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    if taken & set(tables):
        raise ValueError(f"the session already has views {sorted(taken & set(tables))}")
    try:
        for name, df in tables.items():
            df.createTempView(name)
        yield
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)


def init_tables(spark: SparkSession, root: str, schemas: Mapping[str, StructType]) -> dict[str, str]:
    """Create the empty targets of a first run; returns the paths by table name."""
    return {name: init_table(spark, schema, f"{root.rstrip('/')}/init/{name.replace('.', '/')}")
            for name, schema in schemas.items()}


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Update matching keys, insert new ones, keep keys missing from the source.

    ``target LEFT ANTI JOIN source`` keeps the untouched rows; the union adds
    every source row.  Null keys never match, so a null-keyed target row stays
    next to the incoming one.  Both sides shuffle on the keys (or the source is
    broadcast when AQE measures it small).
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def merge_watched(target: DataFrame, source: DataFrame, keys: Sequence[str] = KEYS,
                  not_null: Sequence[str] = (), unique: Sequence[str] = (),
                  non_negative: Sequence[str] = ()) -> tuple[DataFrame, Watch]:
    """``merge_rows`` in one pass that counts the checks of ``source`` on the way.

    Both sides are stacked and meet by one shuffle on the keys, where a source
    row hides the target rows of its key; ``source`` is evaluated once.  Null
    keys never match.  ``unique`` names the columns of the report; they must
    tell the same rows apart as the keys (the date of a year, say).  A key
    group holds one row of each side, unless the run is about to fail for a
    repeated key.
    """
    new = source.select(*target.columns, F.lit(1).alias("_new"))
    both = target.withColumn("_new", F.lit(0)).unionByName(new)
    group = Window.partitionBy(*keys).orderBy(F.desc("_new"))
    whole = Window.partitionBy(*keys).orderBy(F.desc("_new")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    marked = both.withColumn("_nth", F.row_number().over(group)).withColumn("_replaced", F.max("_new").over(whole))
    watched, watch = watch_marked(marked, not_null=not_null, unique=unique or keys, non_negative=non_negative,
                                  only=F.col("_new") == 1, report_unique=bool(unique))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    kept = watched.filter((F.col("_new") == 1) | (F.col("_replaced") == 0) | no_key)
    return kept.select(*target.columns), watch


def upsert_sink(spark: SparkSession, source: DataFrame, target_path: str, output_path: str,
                keys: Sequence[str] = KEYS, schema: StructType | None = None,
                check: Callable[[list], object] | None = None,
                checks: Mapping[str, Sequence[str]] | None = None) -> str:
    """Keyed upsert on plain Parquet.

    Plain Parquet has no ``MERGE INTO``, and overwriting the path being read is
    unsafe, so the merged table is written to ``output_path`` (a new version
    folder); the caller points readers at it.  Raises when the target is
    missing or when the source repeats a key (the result would depend on row
    order); the output folder then goes again.  ``checks`` are counted during
    that write, and ``check`` gets their report before anything is published.
    """
    if output_path.rstrip("/") == target_path.rstrip("/"):
        raise ValueError("upsert must write to a new path, not over its own input")
    target = read_target(spark, target_path, schema)
    if schema is not None:
        assert_schema(source, schema)
    merged, watch = merge_watched(target, source, keys, **(checks or {}))
    _write_checked(spark, output_path, merged.write.mode("errorifexists").parquet, watch, keys, check)
    return output_path


def _write_checked(spark: SparkSession, path: str, write: Callable[[str], None], watch: Watch, keys: Sequence[str],
                   check: Callable[[list], object] | None) -> None:
    """Write, then judge what was counted; a table that fails is removed."""
    write(path)
    try:
        if check:
            check(watch.report())
        if watch.repeated_keys():
            raise DuplicateKeyError(f"source repeats keys {list(keys)}")
    except BaseException:
        Folder(spark, path).delete()
        raise


def write_watched(df: DataFrame, path: str, schema: StructType | None = None,
                  check: Callable[[list], object] | None = None, checks: Mapping[str, Sequence[str]] | None = None,
                  order_by: Sequence[str] = ()) -> list[tuple[str, str, int]]:
    """``replace_sink`` that counts the checks during the write and publishes only what passes.

    ``check`` gets the report while the new rows still lie beside the old ones;
    when it raises, the old ones stay.  ``order_by`` stores the rows sorted.
    """
    if schema is not None:
        assert_schema(df, schema)
    watched, watch = watch_rows(df, **(checks or {}))
    watched = watched.orderBy(*order_by) if order_by else watched

    def write(folder: str) -> None:
        watched.write.parquet(folder)
        if check:
            check(watch.report())

    replace_folder(df.sparkSession, path, write)
    return watch.report()


def partitioned_sink(df: DataFrame, path: str, partition_by: str = "year_date",
                     cluster_by: Sequence[str] = ("country",)) -> str:
    """Date-partitioned folders, rows sorted by the cluster keys inside files.

    ``REBALANCE`` on the partition column lets AQE size the write tasks from
    the shuffle statistics: small dates are coalesced into one file, and a
    date holding a large share of the rows is split across several tasks
    (no sampling job, unlike a range partitioning).  Sorting by the cluster
    keys inside each task gives row groups tight ``country`` min/max
    statistics for data skipping.  The old table stays until the new one is
    complete.
    """
    laid_out = (df.hint("rebalance", partition_by)
                .sortWithinPartitions(partition_by, *cluster_by))
    return replace_folder(df.sparkSession, path, laid_out.write.partitionBy(partition_by).parquet)


def is_partitioned(df: DataFrame, partition_by: str = "year_date") -> bool:
    """Whether a stored table has files and all of them lie in folders of ``partition_by``."""
    files = df.inputFiles()
    return bool(files) and all(f"/{partition_by}=" in f for f in files)


_COMMIT = "_commit.json"


def commit_partitions(spark: SparkSession, target_path: str, staged_path: str) -> None:
    """Exchange the partition folders of a table for the staged ones.

    A record of what is to be moved is put into the table first, in one step.
    The moves that follow may be repeated, so a run that ends midway is
    finished from the record by ``finish_commit``; without a record the table
    is as it was and the staged folders are nothing but scratch.
    """
    target, staged = Folder(spark, target_path), Folder(spark, staged_path)
    target.child(_COMMIT).write_text(json.dumps({"staged": staged.path, "partitions": staged.folders()}))
    finish_commit(spark, target_path)


def finish_commit(spark: SparkSession, target_path: str) -> bool:
    """Do what is left of a recorded commit; returns whether there was one."""
    target = Folder(spark, target_path)
    record = target.child(_COMMIT)
    if not record.exists():
        return False
    todo = json.loads(record.read_text())
    staged = Folder(spark, todo["staged"])
    for name in todo["partitions"]:
        source = staged.child(name)
        if source.exists():  # else it was moved before the run ended
            target.child(name).delete()
            source.move_to(target.child(name))
    record.delete()
    staged.delete()
    spark.catalog.refreshByPath(target.path)
    return True


def upsert_partitions(spark: SparkSession, source: DataFrame, target_path: str, staging_path: str,
                      schema: StructType, keys: Sequence[str] = KEYS,
                      partition_by: str = "year_date",
                      check: Callable[[list], object] | None = None,
                      checks: Mapping[str, Sequence[str]] | None = None) -> str:
    """Keyed upsert into a partitioned table that rewrites only the partitions ``source`` touches.

    The key must determine the partition.  Touched partitions are merged into
    ``staging_path``, judged there like those of ``upsert_sink``, and then moved
    to their places in ``target_path`` without being written again; the files
    of all others stay.  The move is recorded first (``commit_partitions``): a
    run that ends midway is finished by the next one, and until then a reader
    may meet new and old partitions side by side.
    """
    if staging_path.rstrip("/") == target_path.rstrip("/"):
        raise ValueError("the merged partitions must be staged outside their table")
    assert_schema(source, schema)
    target = read_target(spark, target_path, schema)
    # at most one value per folder; as literals they prune the scan to the touched folders
    touched = [r[0] for r in source.select(partition_by).distinct().collect()]
    if not touched:
        return target_path
    column = F.col(partition_by)
    old = target.filter(column.isin([v for v in touched if v is not None])
                        | (column.isNull() & F.lit(None in touched)))
    merged, watch = merge_watched(old.select(*schema.names), source, keys, **(checks or {}))
    _write_checked(spark, staging_path, lambda path: partitioned_sink(merged, path, partition_by), watch, keys, check)
    commit_partitions(spark, target_path, staging_path)
    return target_path


def upsert_partitioned(spark: SparkSession, source: DataFrame, target_path: str, output_path: str, schema: StructType,
                       keys: Sequence[str] = KEYS, partition_by: str = "year_date",
                       check: Callable[[list], object] | None = None,
                       checks: Mapping[str, Sequence[str]] | None = None) -> str:
    """``upsert_partitions``, or, into a table not partitioned yet, a merge written to ``output_path`` as one that is.

    Returns where the merged table lies.
    """
    target = read_target(spark, target_path, schema)
    if is_partitioned(target, partition_by):
        return upsert_partitions(spark, source, target_path, output_path, schema, keys, partition_by, check, checks)
    assert_schema(source, schema)
    merged, watch = merge_watched(target, source, keys, **(checks or {}))
    _write_checked(spark, output_path, lambda path: partitioned_sink(merged, path, partition_by), watch, keys, check)
    return output_path


def read_written(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a stored table whose columns must be those of its declared schema.

    Reading with a schema alone would give nulls for a column that the files
    do not have, so a stored footer is compared first, without a job.
    """
    stored = stored_schema(spark, path, schema)
    if stored is not None:
        got = {f.name: f.dataType for f in stored.fields}
        want = {f.name: f.dataType for f in schema.fields}
        if got != want:
            raise SchemaMismatchError(f"{path} stores {got}, the contract is {want}")
    return spark.read.schema(schema).parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a partitioned table back in contract order (the partition column
    comes back last, as DATE; a null date comes back from the default folder)."""
    return read_written(spark, path, schema).select(*schema.names)
