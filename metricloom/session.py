"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Settings of the jobs where the submit names none. Shuffles start with many partitions and
# are merged at run time to the advisory size, so one value serves small and large inputs;
# the only shuffle of whole rows is that of landing, and a landing of more than some 5 TB
# should start with more. The low open cost packs many small landed documents into a task.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.openCostInBytes": "512k",
    # Pages are collected in object aggregates; past so many of them a task sorts and spills.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16",
    # Keys that a stream remembers lie on the executors' disks.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def job_session(app: str) -> SparkSession:
    """Session for spark-submit jobs; whatever the submit sets goes before ``JOB_CONF``."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in JOB_CONF.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"metricloom-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for written intermediate data.

    Executors on other machines must reach it, so a folder of our own is made only for a
    local master that names none.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return _own_folder(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/metricloom/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends at files that
    survive lost executors, and later joins see the true size."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
