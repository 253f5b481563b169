"""Session construction and shared-storage helpers."""

from __future__ import annotations

import gc
import os
import tempfile
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tarmac",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE on and the UI off (tests, bench, local runs).

    On a cluster the caller's ``spark-submit`` config wins; we only fill in
    what is unset.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = {
        "spark.master": master or f"local[{cpus}]",
        "spark.app.name": app,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or int(cpus)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "16g",
    }
    if "PYSPARK_GATEWAY_PORT" in os.environ:   # started by spark-submit: its settings are in the JVM already
        given = SparkConf()
        wanted = {k: v for k, v in wanted.items() if not given.contains(k)}
    spark = SparkSession.builder.config(map=wanted).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names that folder; we read it from the session and set our
    own only when it is unset on a local master.  On a cluster a machine-local
    folder would lose results, so an unset folder is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.conf.get("spark.master", "local").startswith("local") or \
                spark.conf.get("spark.master", "").startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tarmac-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - remote (Connect) sessions take the setting from the conf
        pass
    return d


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def checkpoint(df):
    """Reliable checkpoint into the shared checkpoint folder (cuts lineage).

    Used where an iterative or multi-branch plan would otherwise recompute a
    deep lineage; never a machine-local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if _STEP is not None:
        _STEP.append(df.sparkSession.sparkContext.getCheckpointDir())   # a folder of its own
    return df.checkpoint(eager=True)


#: folders of the checkpoints made within the step that runs
_STEP: list[str] | None = None


@contextmanager
def step(spark: SparkSession):
    """Checkpoints made within are removed at its end, when nothing reads them any more, and Spark drops the shuffle files
    of plans that are gone.  For steps that run one after the other."""
    global _STEP
    outer, _STEP = _STEP, []
    try:
        yield
    finally:
        made, _STEP = _STEP, outer
        sc = spark.sparkContext
        for d in made:
            path = sc._jvm.org.apache.hadoop.fs.Path(d)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        sc._jvm.System.gc()   # Spark's cleaner follows it


_MATERIALISED: dict[tuple, str] = {}


def _source_stamp(spark: SparkSession, paths) -> tuple:
    """(path, size, files, mtime) of the inputs, so a changed source rebuilds its tables."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        try:
            st, held = fs.getFileStatus(hp), fs.getContentSummary(hp)   # of all files below a folder
            out.append((p, held.getLength(), held.getFileCount(), st.getModificationTime()))
        except Exception:  # noqa: BLE001 - missing input: no stamp, build fails later
            out.append((p, -1, -1, -1))
    return tuple(out)


def materialised(spark: SparkSession, name: str, inputs, build, partition_by=None):
    """Build a derived table once per session and data version, write it to the
    shared checkpoint folder (Parquet) and return a reader of it.

    Later queries read the written table instead of recomputing its lineage,
    and a lost executor never needs more than the table's own files.
    """
    try:
        key = (spark.sparkContext.applicationId, name, _source_stamp(spark, inputs))
    except Exception:  # noqa: BLE001 - no JVM handle (remote session): plain lazy plan
        return build()
    path = _MATERIALISED.get(key)
    if path is None:
        import uuid
        path = shared_path(spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")
        w = build().write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        _MATERIALISED[key] = path
    return spark.read.parquet(path)


_REMEMBERED: dict[tuple, object] = {}


def remembered(spark: SparkSession, name: str, inputs, compute):
    """A number (or a few) derived from the inputs, computed once per session and data version."""
    try:
        key = (spark.sparkContext.applicationId, name, _source_stamp(spark, inputs))
    except Exception:  # noqa: BLE001 - no JVM handle (remote session): computed each time
        return compute()
    if key not in _REMEMBERED:
        _REMEMBERED[key] = compute()
    return _REMEMBERED[key]


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tarmac`` importable in the Python workers (pandas UDFs, mapInPandas).

    The package is zipped once per application into the shared checkpoint
    folder when that folder is a local/shared file system path (otherwise a
    driver temp file) and registered with ``addPyFile``, which Spark
    distributes to every executor.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - remote session: the package must be installed on the cluster
        return
    if app in _SHIPPED:
        return
    import os
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = ensure_checkpoint_dir(spark)
    local = base[len("file:"):] if base.startswith("file:") else base
    folder = local if "://" not in local and os.path.isdir(os.path.dirname(local.rstrip("/")) or "/") else \
        tempfile.mkdtemp(prefix="tarmac-py-")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"tarmac-{app}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(app)
