"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on; all can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Generated methods above this size are never compiled by the JVM and run several times
    # slower than the same work split over operators, which the planner then falls back to.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
PREPARED = (
    "spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.codegen.hugeMethodLimit",
)

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_work_root: dict[str, str] = {}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session for the command-line jobs; `conf` keys use `__` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


PARTITIONS = "spark.sql.shuffle.partitions"
PARTITIONS_PER_CORE = 3


def prepare(spark: SparkSession) -> SparkSession:
    """Put the settings that results and scale depend on onto an existing session.

    The default number of shuffle partitions would make them far too large on many cores,
    so it is raised with the cluster, never lowered and never if somebody has chosen it.
    Adaptive execution joins small partitions again.
    """
    for key in PREPARED:
        if spark.conf.get(key).lower() != RUNTIME_CONF[key].lower():
            spark.conf.set(key, RUNTIME_CONF[key])
    wanted = PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    chosen = spark.sparkContext.getConf().contains(PARTITIONS)
    if not chosen and int(spark.conf.get(PARTITIONS)) < wanted:
        spark.conf.set(PARTITIONS, str(wanted))
    return spark


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for one stream.

    The number of state partitions is fixed at the first start of a checkpoint, so it is
    chosen here from the cluster's cores and not left to the batch default, and the
    caller's own session keeps its settings.
    """
    session = spark.newSession()
    for key, value in RUNTIME_CONF.items():
        session.conf.set(key, value)
    session.conf.set(PARTITIONS, str(state_partitions or spark.sparkContext.defaultParallelism))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return session


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, models and intermediate tables.

    It is the folder the cluster names in `spark.checkpoint.dir`. Only a local master may
    fall back to a temporary folder, since there all tasks run on this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder that all executors share"
        )
    app = spark.sparkContext.applicationId
    if app not in _work_root:
        _work_root[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _work_root[app]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is ever written over."""
    return f"{work_root(spark)}/tiffin/{label}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folder_exists(spark: SparkSession, path: str) -> bool:
    system, target = _place(spark, path)
    return system.exists(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller owns; one that is not there is no fault."""
    system, target = _place(spark, path)
    system.delete(target, True)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a table under the shared folder that nothing reads any more."""
    if not path.startswith(f"{work_root(spark)}/tiffin/"):
        raise ValueError(f"{path} is not under the work folder")
    delete_folder(spark, path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative jobs a reliable checkpoint folder unless the cluster already did."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{work_root(spark)}/rdd-checkpoints")
