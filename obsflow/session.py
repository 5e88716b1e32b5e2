"""Session set-up and the shared work folder.

Settings that matter for correctness are pinned here: UTC session time zone
(window bounds are rendered as text), ANSI mode left on (external data goes
through ``try_*`` functions instead), adaptive execution for batch jobs.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows sent to Python are batched by size: long texts must not pile up in a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # Writers replace only the partitions a job touches (batch_id=N, version=N).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming state on local disk (checkpointed), not on the heap: a backlog replayed in one
    # micro-batch may hold millions of open windows until the watermark passes them.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # The JVM does not JIT-compile methods above 8000 bytes of bytecode; a whole-stage
    # method that large (nine aggregates in one stage) would run interpreted, 3x slower.
    # At this limit Spark falls back to per-operator code for just that stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(master: str | None = None, app: str = "obsflow",
              shuffle_partitions: int | None = None, extra_conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings applied."""
    builder = SparkSession.builder.appName(app)
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    return spark


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """``configure`` and, once per application, send the package to the executors.

    Executors' Python has no path to the folder that the driver imports from.
    """
    configure(spark)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="obsflow-src-"), "obsflow_src.zip")  # served by the driver
        with zipfile.ZipFile(path, "w") as z:
            for top, _, names in os.walk(here):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(top, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is read, never replaced.
    Only when it is unset on a local master (tests, a laptop) a folder is created
    and registered; elsewhere executors could not read the driver's own folders.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="obsflow-ckpt-")
        sc.setCheckpointDir(root)
        return sc.getCheckpointDir() or root
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)   # the configured shared folder, so DataFrame.checkpoint() can use it
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint root for one job's tables.

    Nothing is created here: Spark's writers and stream checkpoints create it
    on the shared file system.
    """
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/obsflow/{name}-{uuid.uuid4().hex[:12]}"


def size_for_input(spark: SparkSession, input_bytes: int, total_cores: int,
                   target_partition_bytes: int = 256 << 20) -> int:
    """Size scan splits and shuffles for an input of ``input_bytes`` on ``total_cores`` cores.

    Scan splits and the adaptive advisory size are ``target_partition_bytes``
    (fits an executor core's share of memory, spills cleanly); the initial
    shuffle partition count covers a full-size shuffle of the input and AQE
    coalesces it down when partial aggregation leaves little to move. Call it
    before a stateful stream starts for the first time: the checkpoint fixes
    that query's partition count.
    """
    n = max(total_cores * 2, -(-int(input_bytes) // target_partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
