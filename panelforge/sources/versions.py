"""Which stored version of a table is the current one.

A warehouse folder keeps one pointer file per table, ``current/<table>``, that
holds the path of the table's current version.  A run writes its version
somewhere else and replaces the pointer by one rename, so a reader, or the next
run in another process, finds either the old version or the new one and never
a half-written table.  Paths inside the warehouse are kept relative to it: the
folder may be moved or mounted elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import SparkSession

from panelforge.sources.files import Folder

_POINTERS = "current"


def publish(spark: SparkSession, root: str, paths: Mapping[str, str]) -> None:
    """Point every table of ``paths`` at its new version, one rename each."""
    base = Folder(spark, root)
    for table, path in paths.items():
        inside = path.startswith(f"{base.path}/")
        base.child(f"{_POINTERS}/{table}").write_text(path[len(base.path) + 1:] if inside else path)


def current(spark: SparkSession, root: str, tables: Iterable[str]) -> dict[str, str]:
    """Path of the current version of those ``tables`` that have one."""
    return all_current(spark, root, set(tables).__contains__)


def all_current(spark: SparkSession, root: str, wanted: Callable[[str], bool] = lambda table: True) -> dict[str, str]:
    """Path of the current version of every published table."""
    base = Folder(spark, root)
    out = {}
    for table in base.child(_POINTERS).files():
        if wanted(table):
            path = base.child(f"{_POINTERS}/{table}").read_text().strip()
            out[table] = path if path.startswith("/") or ":/" in path else f"{base.path}/{path}"
    return out
