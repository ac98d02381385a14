"""Session settings, shared work folders and sizing helpers."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on. All of them can be set on a live
# session, so they also apply to a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small but compute-heavy shuffles still keep all cores busy. Large ones are
    # merged up to the advisory size as usual.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where the split costs one more shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # State of stream joins is kept on disk beside memory, not in the heap alone.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Counting the rows of a store costs one more read for each write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # A join of streams keeps one store a partition, not four, so a commit copies a quarter
    # of the files. A stream goes on in the format its checkpoint began with.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # Indexes and filters of a store lie in this cache. With 8 MB, the default, those of some
    # million keys push each other out, and every lookup reads them from disk again.
    "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "64",
    # A stopped run's stores hold their local files until the next maintenance.
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
}

# Sizes a session may have smaller, not larger. Partitions of a shuffle are merged up to
# the first one: a task that sorts or groups what it reads holds many times as much.
LARGEST = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, value in LARGEST.items():
        if size(spark.conf.get(key)) > size(value):
            spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "skylag",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Create (or fetch) a session. Without ``master`` the submit command decides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # All blocks are on this machine: reading them by mapper saves nothing
            # and leaves cores idle when there are few input files.
            conf.setdefault("spark.sql.adaptive.localShuffleReader.enabled", "false")
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **LARGEST, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def state_partitions(spark: SparkSession, count: int | None = None):
    """Start stateful streams inside with ``count`` partitions, by default one for
    each core. A stream keeps the number it first started with."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(count or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# Fallback folders of local sessions, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="skylag-")
        atexit.register(shutil.rmtree, _LOCAL_ROOTS[app], ignore_errors=True)
    return _LOCAL_ROOTS[app]


# Paths given out inside ``scratch``, of each level.
_SCRATCH: list[list[str]] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    for held in _SCRATCH[-1:]:
        held.append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Remove at the end what was written to work paths given out inside. Results must
    be stored by then, for tables that are read lazily would miss their files."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            remove(spark, path)


def materialise(df, name: str):
    """Write ``df`` once to the shared folder and return the table read back.

    Used where several jobs read the same intermediate result: it cuts lineage,
    survives lost executors and gives the planner true sizes.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let Python workers of this machine import the package from where it lies.

    A cluster gets it by ``--py-files`` or an installed package; the extra path is
    then one that does not exist.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def _placed(spark: SparkSession, path: str):
    """The file system of a path, by the names Spark knows, and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def local_path(spark: SparkSession, path: str) -> str | None:
    """A path as this machine's file system names it; None if it lies elsewhere."""
    system, place = _placed(spark, path)
    full = system.makeQualified(place).toUri()
    return full.getPath() if full.getScheme() == "file" else None


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none where there is no such folder."""
    system, place = _placed(spark, path)
    if not system.exists(place):
        return []
    return sorted(found.getPath().getName() for found in system.listStatus(place))


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a short file that must not be there yet. It appears as a whole."""
    system, place = _placed(spark, path)
    _, draft = _placed(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = system.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if system.exists(place) or not system.rename(draft, place):
        system.delete(draft, False)
        raise FileExistsError(path)


def get_text(spark: SparkSession, path: str) -> str:
    """The text of a short file."""
    system, place = _placed(spark, path)
    source = system.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds; nothing happens where there is none."""
    system, place = _placed(spark, path)
    system.delete(place, True)
