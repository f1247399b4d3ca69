"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN_SCRATCH: dict[str, str] = {}


def build_session(app: str = "tallyguard", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` keys use ``__`` for dots."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared checkpoint folder.

    The folder is the one in ``spark.checkpoint.dir`` or given to ``setCheckpointDir``. Only a session
    whose executors are this very process may do without; its private folder goes when Python ends.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        given = context._jsc.sc().getCheckpointDir()
        shared = given.get() if given.isDefined() else None
    if shared:
        return f"{shared.rstrip('/')}/tallyguard-{context.applicationId}"
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _OWN_SCRATCH:
        own = tempfile.mkdtemp(prefix="tallyguard-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _OWN_SCRATCH[context.applicationId] = own
    return _OWN_SCRATCH[context.applicationId]


def release_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; frames that still read them are void then."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch root."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` once as a Parquet table in the scratch folder and read it back.

    Cuts lineage on reliable storage: lost executors re-read files, and values that depend on the
    run (row ids, sampled range bounds) are fixed from here on. ``rows_per_file`` limits the rows of
    a file where rows are large.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_table(table: DataFrame) -> None:
    """Delete a table that ``stored`` returned; frames that still read it are void then."""
    spark = table.sparkSession
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings for the writes inside, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
