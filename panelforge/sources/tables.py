"""Readers for the input tables (Parquet on any Hadoop file system)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from panelforge.contracts import DATASETS, GEO_COLUMN, SOURCE_SCHEMAS
from panelforge.sources.files import stored_schema, wrong_columns


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


class SourceSchemaError(ValueError):
    pass


def read_table(spark: SparkSession, base: str, name: str, *columns: str) -> DataFrame:
    """Read one table; naming the columns keeps the scan's ReadSchema narrow.

    ``base`` may be a local path or any URI the cluster's Hadoop configuration
    can reach (``s3a://``, ``gs://``, ``abfs://``); credentials belong in the
    Spark configuration, never in code.
    """
    df = spark.read.parquet(table_path(base, name))
    return df.select(*columns) if columns else df


def read_declared(spark: SparkSession, base: str, name: str, schema: StructType) -> DataFrame:
    """Read the declared columns of a table, without a job that infers them.

    A declared column that the files lack would come back as nulls, and one of
    another type would end the job that reads it, so the footer of one file is
    compared first; other columns of the files are not read.
    """
    path = table_path(base, name)
    wrong = wrong_columns(schema, path, spark)
    if wrong:
        raise SourceSchemaError(f"{path}: {'; '.join(wrong)}")
    return spark.read.schema(schema).parquet(path)


def read_source(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One of the tables that the extracts are derived from, by its declared schema."""
    return read_declared(spark, base, name, SOURCE_SCHEMAS[name])


def read_extract(spark: SparkSession, base: str, dataset: str) -> DataFrame:
    """A landed wide extract: its dimensions are declared, its year columns are those of the footer."""
    path = table_path(base, dataset)
    stored = stored_schema(spark, path)
    if stored is None:
        raise SourceSchemaError(f"{path}: no data files")
    ids = {c: StringType() for c in (*DATASETS[dataset].id_columns, GEO_COLUMN)}
    declared = StructType([StructField(f.name, ids.get(f.name, DoubleType())) for f in stored.fields])
    missing = [c for c in DATASETS[dataset].id_columns if c not in stored.names and
               not (c == "country" and GEO_COLUMN in stored.names)]
    wrong = [f"{c} is missing" for c in missing] + wrong_columns(declared, path, spark)
    if wrong:
        raise SourceSchemaError(f"{path}: {'; '.join(wrong)}")
    return spark.read.schema(declared).parquet(path)
