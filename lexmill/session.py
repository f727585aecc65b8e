"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Tables written by `materialize`, by application: (catalog name or None, path).
_WRITTEN: dict[str, list[tuple[str | None, str]]] = {}

# Folders of local sessions that name none, by application: the setting cannot
# be changed in a running session.
_LOCAL: dict[str, str] = {}


def get_session(app: str = "lexmill", master: str | None = None,
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build a session with the settings every job here assumes.

    Adaptive execution sizes the shuffles and splits skewed join partitions,
    and timestamps are read as UTC.  `master` and `shuffle_partitions` are left
    to the cluster unless given.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`.

    Where it is unset, a local session gets a folder of its own; a cluster
    session is refused, because no executor could read a driver-local path.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or _LOCAL.get(spark.sparkContext.applicationId)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="lexmill-")
    _LOCAL[spark.sparkContext.applicationId] = folder
    return folder


def materialize(df: DataFrame, name: str = "table", key: str | None = None,
                schema=None, parts: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The copy survives lost executors, is computed once however often it is
    read, and carries its true size, so Catalyst decides from a measured size
    whether a join may broadcast it.  With `key` the table is bucketed by it,
    with as many buckets as shuffle partitions: reading it back is already laid
    out by key and needs no shuffle.  `schema` overrides the schema on reading.
    With `parts` the table has a folder for each value of that column.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{table}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append((table if key else None, path))
    if key:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if spark.sparkContext.master.startswith("local"):
            # one machine gains nothing from many more files than cores
            buckets = min(buckets, spark.sparkContext.defaultParallelism)
        (df.write.format("parquet").option("path", path).bucketBy(buckets, key)
         .saveAsTable(table))
        return spark.table(table)
    df.write.mode("overwrite").parquet(path, partitionBy=parts)
    return spark.read.schema(schema or df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Drop a table that `materialize` has written without a key, once nothing reads it."""
    spark = df.sparkSession
    written = _WRITTEN.get(spark.sparkContext.applicationId, [])
    names = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
    for entry in [x for x in written if x[1].rsplit("/", 1)[1] in names]:
        delete_folder(spark, entry[1])
        written.remove(entry)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder through Spark's own file system layer."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_materialized(spark: SparkSession, keep: tuple[str, ...] = ()) -> int:
    """Drop every table this application has written by `materialize`, but those
    whose name starts with one of `keep`; returns how many went.

    For the end of a job: results that still read such a table must be written
    or collected before.
    """
    written = _WRITTEN.get(spark.sparkContext.applicationId, [])
    gone = [x for x in written if not x[1].rsplit("/", 1)[1].startswith(tuple(keep))]
    for table, path in gone:
        if table:
            spark.sql(f"DROP TABLE IF EXISTS `{table}`")
        delete_folder(spark, path)
    written[:] = [x for x in written if x not in gone]
    return len(gone)
