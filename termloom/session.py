"""Session helpers for tests, the benchmark and single-host use."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app_name: str = "termloom", scratch: str | None = None) -> SparkSession:
    """A local session. On a cluster, pass your own session to every function."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Where it is unset, a session within one JVM uses a
    folder of its warehouse; on a cluster that is an error, because nothing says that every
    executor sees what another has written.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Narrow rows of a file.
GATHERED_ROWS = 10_000


def _write(df: DataFrame, path: str, rows: int | None = None) -> DataFrame:
    if rows is not None:
        df = df.repartition(max(1, -(-rows // GATHERED_ROWS)))
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def staged(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """The same rows, written once to the shared folder and read back.

    For narrow results of a costly scan that several branches of a plan read. Of a table of a
    few numbers a row, ``rows`` says about how many it has: it gets as many files as these
    ask for, not one of each task. A file costs more than its rows where these are few; on a
    local file system without Hadoop's native library, several processes of the executor.
    """
    return _write(df, scratch_path(df.sparkSession, name), rows)


class Staging:
    """Staged tables that are emptied as soon as no plan reads them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def keep(self, name: str, df: DataFrame, rows: int | None = None) -> DataFrame:
        self.paths[name] = scratch_path(self.spark, name)
        return _write(df, self.paths[name], rows)

    def drop(self, *names: str) -> None:
        """Give back what these take. Whatever was made of them must have been staged itself."""
        for name in names:
            self.spark.range(0).write.mode("overwrite").parquet(self.paths.pop(name))
