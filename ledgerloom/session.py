"""Session construction and the helpers that make a data-dependent plan safe."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# A shuffled side whose measured size is below this is broadcast by adaptive execution.
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app_name: str = "ledgerloom", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and skew handling on.

    ``master`` and resources stay with the submitter unless given here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_BYTES),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Functions of pandas UDFs are found by their module, so Python workers need the
    package although they start in another folder.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-package-"), "ledgerloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for written intermediate tables, set from ``spark.checkpoint.dir`` if it is not yet."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and is computed once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Repartition ahead of work that is heavy for its bytes.

    Adaptive coalescing goes by size and would leave such work to a few tasks; a
    stated number of partitions is left alone.
    """
    spark = df.sparkSession
    count = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(count, *columns)


def null_safe_on(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]):
    """Conjunction of ``<=>`` over column pairs, so NULL keys match each other."""
    condition = None
    for a, b in pairs:
        term = left[f"`{a}`"].eqNullSafe(right[f"`{b}`"])
        condition = term if condition is None else condition & term
    return condition
