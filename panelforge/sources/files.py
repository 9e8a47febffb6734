"""Folders and small files on any Hadoop file system, handled by the driver.

Only names move here, never rows: every call works on one folder or one file
of a few bytes.  A rename replaces a folder or file in one step on HDFS and on
local disks; an object store copies instead, where only the replacement of a
single small file is atomic.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql.types import (DataType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType, TimestampType)


class FileMoveError(OSError):
    pass


class Folder:
    """A path on the file system that it names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._at = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._at.getFileSystem(self._conf)

    def child(self, name: str) -> Folder:
        return Folder(self.spark, f"{self.path}/{name}")

    def beside(self, suffix: str) -> Folder:
        return Folder(self.spark, f"{self.path}.{suffix}")

    def new_beside(self) -> Folder:
        return self.beside(f"new-{uuid.uuid4().hex[:12]}")

    def exists(self) -> bool:
        return self._files.exists(self._at)

    def delete(self) -> None:
        self._files.delete(self._at, True)

    def move_to(self, other: Folder) -> None:
        """Rename; the other path must be free."""
        if other.exists():
            raise FileMoveError(f"{other.path} is in the way of {self.path}")
        parent = other._at.getParent()
        if parent is not None:
            other._files.mkdirs(parent)
        if not self._files.rename(self._at, other._at):
            raise FileMoveError(f"could not move {self.path} to {other.path}")

    def folders(self) -> list[str]:
        """Names of the folders inside, without hidden ones."""
        return sorted(s.getPath().getName() for s in self._listed() if s.isDirectory())

    def files(self) -> list[str]:
        """Names of the files inside, without hidden ones."""
        return sorted(s.getPath().getName() for s in self._listed() if s.isFile())

    def _listed(self) -> list:
        if not self.exists():
            return []
        return [s for s in self._files.listStatus(self._at) if not s.getPath().getName().startswith(("_", "."))]

    def read_text(self) -> str:
        stream = self._files.open(self._at)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, text: str) -> None:
        """Replace the file: the text is written beside it, then one rename puts it in place."""
        beside = self.new_beside()
        stream = beside._files.create(beside._at, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at.toUri(), self._conf)
        context.rename(beside._at, self._at, options)


# How Parquet footers name the columns of each type.
_STORED: dict[DataType, tuple[tuple[str, str], ...]] = {
    StringType(): (("BINARY", "STRING"),),
    LongType(): (("INT64", ""), ("INT64", "INTEGER(64,true)")),
    IntegerType(): (("INT32", ""), ("INT32", "INTEGER(32,true)")),
    DoubleType(): (("DOUBLE", ""),),
    DateType(): (("INT32", "DATE"),),
    TimestampType(): (("INT64", "TIMESTAMP(MICROS,true)"), ("INT64", "TIMESTAMP(MILLIS,true)")),
    TimestampNTZType(): (("INT64", "TIMESTAMP(MICROS,false)"), ("INT64", "TIMESTAMP(MILLIS,false)")),
}


def _first_file(folder: Folder) -> tuple[Folder, list[str]] | None:
    """A data file below a table's folder and the partition columns on the way; the path itself if it is a file."""
    if folder._files.getFileStatus(folder._at).isFile():
        return folder, []
    names = folder.files()
    if names:
        return folder.child(names[0]), []
    for name in folder.folders():
        found = _first_file(folder.child(name))
        if found:
            column, _, value = name.partition("=")
            return found[0], ([column] if value else []) + found[1]
    return None


def footer_types(spark: SparkSession, path: str) -> tuple[dict[str, tuple[str, str]], list[str]] | None:
    """Column -> (physical, logical) type in the footer of one data file, and the partition columns.

    Read by the driver: no Spark job.  None for a table without data files.
    """
    found = _first_file(Folder(spark, path))
    if found is None:
        return None
    file, partitions = found
    jvm = spark.sparkContext._jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(file._at, file._conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        out = {}
        for field in reader.getFooter().getFileMetaData().getSchema().getFields():
            logical = field.getLogicalTypeAnnotation()
            physical = field.asPrimitiveType().getPrimitiveTypeName().name() if field.isPrimitive() else "GROUP"
            out[field.getName()] = physical, "" if logical is None else logical.toString()
        return out, partitions
    finally:
        reader.close()


def stored_schema(spark: SparkSession, path: str, of_partitions: StructType | None = None) -> StructType | None:
    """The columns of a stored table by its footer; partition columns take their types from ``of_partitions``."""
    found = footer_types(spark, path)
    if found is None:
        return None
    types = {stored: kind for kind, names in _STORED.items() for stored in names}
    fields = [StructField(name, types.get(stored, StringType() if stored == ("BINARY", "") else None) or
                          _unknown(path, name, stored)) for name, stored in found[0].items()]
    fields += [f for f in (of_partitions.fields if of_partitions else []) if f.name in found[1]]
    return StructType(fields)


def _unknown(path: str, name: str, stored: tuple[str, str]) -> DataType:
    raise TypeError(f"{path}: column {name} is stored as {stored}, which no declared type names")


def wrong_columns(declared: StructType, path: str, spark: SparkSession) -> list[str]:
    """What a footer says against the declared columns; other columns of the file do not matter."""
    found = footer_types(spark, path)
    if found is None:
        return []
    stored, partitions = found
    out = []
    for f in declared.fields:
        if f.name in partitions:
            continue
        if f.name not in stored:
            out.append(f"{f.name} is missing")
        elif stored[f.name] not in _STORED.get(f.dataType, ()):
            out.append(f"{f.name} is stored as {' '.join(stored[f.name]).strip()}, not {f.dataType.simpleString()}")
    return out
