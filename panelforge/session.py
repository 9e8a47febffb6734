"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Results depend on these: a bad year label must raise, a date must not move by a day.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}
# Fixed once the JVM runs, so only for sessions that this module starts on one machine.
_LOCAL = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python call-site capture costs several JVM round trips per column
    # function; plans here are built from hundreds of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


ADVISORY_PARTITION_BYTES = 256 * 1024 * 1024


def sizing_conf(input_bytes: int, advisory_bytes: int = ADVISORY_PARTITION_BYTES) -> dict[str, str]:
    """Shuffle sizing for an input of ``input_bytes`` (compressed, on disk).

    The largest shuffle here (pre-aggregated ``lineitem``) is of the order of
    the input, so the initial partition count is input / advisory size, at
    every size; AQE then coalesces partitions towards ``advisory_bytes`` and
    splits skewed ones.  Scan splits use the same size.  ``advisory_bytes`` is
    the one parameter: at 100 TB, 1 GB gives about 100,000 partitions.
    """
    initial = str(max(1, -(-input_bytes // advisory_bytes)))
    return {
        "spark.sql.shuffle.partitions": initial,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": initial,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_bytes),
        "spark.sql.files.maxPartitionBytes": str(advisory_bytes),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "panelforge", driver_memory: str | None = None,
                  input_bytes: int | None = None,
                  conf: Mapping[str, str] | None = None) -> SparkSession:
    """Return a session with the settings the library relies on.

    On a cluster the master and most settings come from spark-submit; here
    only what is missing is filled in, so a setting that is given stays.  The
    two that results depend on (``_REQUIRED``) raise where another value is
    given.  Pass ``input_bytes`` to size the shuffles from the data
    (``sizing_conf``); ``shuffle_partitions`` sets the count itself (tests use
    the core count) and ``conf`` any other setting.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    local = _LOCAL if master and is_local_master(master) else {}
    for key, value in {**local, **(conf or {})}.items():
        builder = builder.config(key, value)
    if driver_memory:  # only effective when this call starts the JVM (local runs)
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    sizes = sizing_conf(input_bytes) if input_bytes else {}
    fill_settings(spark, {**_REQUIRED, **_DEFAULTS, **sizes})
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


class SettingError(ValueError):
    pass


def fill_settings(spark: SparkSession, settings: Mapping[str, str]) -> None:
    """Set what the session was not given; raise where a required value differs."""
    given = spark.conf.getAll
    wrong = {k: given[k] for k, v in _REQUIRED.items() if k in given and given[k].lower() != v.lower()}
    if wrong:
        raise SettingError(f"given {wrong}, results need {_REQUIRED}")
    for key, value in settings.items():
        if key not in given:
            spark.conf.set(key, value)


class MissingCheckpointDirError(RuntimeError):
    pass


def is_local_master(master: str) -> bool:
    """One JVM runs driver and tasks: ``local`` or ``local[...]``, not ``local-cluster[...]``."""
    return master == "local" or master.startswith("local[")


def _scratch_dir() -> str:
    return tempfile.mkdtemp(prefix="panelforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it.  Only a local session (tests, single-machine runs)
    gets a scratch folder of its own when it is unset; on a cluster a
    machine-local folder would leave each executor writing to its own disk,
    so an unset setting is an error there.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local_master(sc.master):
            raise MissingCheckpointDirError(
                "set spark.checkpoint.dir to a folder every executor can reach")
        configured = _scratch_dir()
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under ``checkpoint_root``, removed when the driver JVM ends."""
    path = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


_SCOPES: list[list[str]] = []  # folders made inside the open scopes, the innermost last


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch folders made inside it, for work whose result is stored elsewhere.

    Frames made inside that were not stored can no longer be read.
    """
    folders: list[str] = []
    _SCOPES.append(folders)
    try:
        yield
    finally:
        del _SCOPES[next(i for i, scope in enumerate(_SCOPES) if scope is folders)]
        for path in folders:
            remove_dir(spark, path)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder before the JVM ends."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
