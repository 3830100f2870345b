"""Tables as Parquet folders, or in a database over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableStore:
    """Where tables live.

    ``location`` is the folder that holds one Parquet folder per table, or a JDBC URL.
    ``options`` go to the reader and writer as they are: driver, user and password, and for
    a parallel JDBC read ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``.
    """

    location: str
    options: dict[str, str] = field(default_factory=dict)

    @property
    def is_jdbc(self) -> bool:
        return self.location.startswith("jdbc:")

    def path(self, name: str) -> str:
        return f"{self.location.rstrip('/')}/{name}"


READ_ONLY = ("partitionColumn", "lowerBound", "upperBound", "fetchsize")


def jdbc_options(store: TableStore, name: str, writing: bool = False) -> dict[str, str]:
    """JDBC options of one table. A parallel read needs its four options together; on writing
    ``numPartitions`` limits the number of connections."""
    split = [o for o in READ_ONLY[:3] if o in store.options]
    if split and (len(split) < 3 or "numPartitions" not in store.options):
        raise ValueError("a parallel read needs partitionColumn, lowerBound, upperBound and numPartitions")
    if not writing:
        return {"fetchsize": "10000", **store.options, "url": store.location, "dbtable": name}
    kept = {k: v for k, v in store.options.items() if k not in READ_ONLY}
    return {"batchsize": "10000", **kept, "url": store.location, "dbtable": name}


def read_table(spark: SparkSession, store: TableStore, name: str) -> DataFrame:
    if store.is_jdbc:
        return spark.read.format("jdbc").options(**jdbc_options(store, name)).load()
    return spark.read.options(**store.options).parquet(store.path(name))


def write_table(df: DataFrame, store: TableStore, name: str, mode: str = "errorifexists") -> None:
    """Create the table; by default an existing one is an error."""
    if store.is_jdbc:
        df.write.format("jdbc").options(**jdbc_options(store, name, writing=True)).mode(mode).save()
    else:
        df.write.mode(mode).options(**store.options).parquet(store.path(name))


def write_snapshot(df: DataFrame, store: TableStore, name: str, day: date | str | None = None) -> None:
    """Add snapshots to a table partitioned by ``snapshot_date``: the given day's, or those
    of the days in the column of that name. Writing a day again replaces only that day."""
    if store.is_jdbc:
        raise ValueError("snapshots are written to a partitioned folder")
    if day is None:
        # Brings each day's rows together in files of a good size; a large day is split.
        dated = df.hint("rebalance", "snapshot_date")
    else:
        dated = df.withColumn("snapshot_date", F.lit(str(day)).cast("date")).hint("rebalance")
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(store.path(name))
    )
