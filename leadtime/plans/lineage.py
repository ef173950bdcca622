"""Where intermediate results may be kept so that they survive a lost executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_private_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Shared folder of the cluster, taken from ``spark.checkpoint.dir``.

    Only a local session that names none gets a private folder; on a cluster executors would write
    to disks of their own, so a missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _private_dirs:
            _private_dirs[app] = tempfile.mkdtemp(prefix="leadtime-")
        base = _private_dirs[app]
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet, below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def join_sized(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a reduced side whose size is settled first.

    The reduced side (one row per entity, family or source) is written once. Spark then plans with
    its real size: below ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast and the large side
    is not shuffled, however uneven its keys are; above it both sides are shuffled and adaptive
    execution splits the uneven partitions.
    """
    on = [on] if isinstance(on, str) else list(on)
    return join_null_safe(big, materialize(small, "reduced"), on, how)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same name in which NULL equals NULL, so no row is lost for its key."""
    names = {c: f"_on_{c}" for c in on}
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(k)) for c, k in names.items()))
    return left.join(right.withColumnsRenamed(names), same, how).drop(*names.values())


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the rows once and read them back: later branches do not recompute them."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
