"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "genoweave", cpus: int | None = None) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    cores = "*" if cpus is None else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    """Let adaptive execution split a hot join key even if that costs another shuffle, and hand
    filters to the block-compressed call files.

    For sessions of one's own; queries leave the session as it is. Set the same on a cluster.
    """
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for written intermediates: the one that spark.checkpoint.dir or the context names,
    else one below the warehouse, which executors share as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediates"


def written(df: DataFrame) -> DataFrame:
    """`df` as a table in the shared folder.

    Used where several later steps need the same expensive rows: they are computed once,
    in the form they take after merging, and outlive lost executors.
    """
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Paths handed out in this process, by application.
_HANDED_OUT: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to, below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _HANDED_OUT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


# Catalog tables of this process that go with the written files, by application.
_TABLES: dict[str, list[str]] = {}


def scratch_table(spark: SparkSession, name: str) -> str:
    """A table name nobody else uses; `remove_written` drops the table."""
    table = f"{name}_{uuid.uuid4().hex}"
    drop_later(spark, table)
    return table


def drop_later(spark: SparkSession, table: str) -> None:
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(table)


def remove_written(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Deletes `paths`, or all this application has written to the shared folder; their number.

    Without `paths` the tables of `scratch_table` are dropped too. For the end of a job: DataFrames that
    still read them can't be used afterwards.
    """
    if paths is None:
        paths = _HANDED_OUT.pop(spark.sparkContext.applicationId, [])
        for table in _TABLES.pop(spark.sparkContext.applicationId, []):
            spark.sql(f"drop table if exists `{table}`")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(paths)
