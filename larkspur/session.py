"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "larkspur", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; pass cluster settings as ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only used when the session itself is local.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="larkspur-"))
    return context.getCheckpointDir()


_WRITTEN: list[str] = []  # scratch paths handed out and not dropped yet


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared scratch folder."""
    path = f"{scratch_root(spark)}/larkspur-{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete what was written below the scratch folder since the last call; returns the number of paths.

    Call it when the results that read it are no longer needed.
    """
    paths = _WRITTEN[:]
    del _WRITTEN[: len(paths)]
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(paths)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete one scratch path that nothing reads any more, before :func:`drop_scratch` would."""
    _WRITTEN.remove(path)
    delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the shared scratch folder, by Spark's file systems."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative estimators cut their lineage in the checkpoint directory."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    Cuts the lineage, survives the loss of executors, and unlike a cache lets
    later reads prune columns and see real file sizes. The job runs now, while the
    plan is built: operators that use it work before their result is asked for.
    :func:`drop_scratch` deletes what was written.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Deal a scan with fewer splits than cores over all cores before heavy work.

    A large input has far more splits than cores and is left alone. Give a bare
    scan: its splits are known from the files alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *keys)
