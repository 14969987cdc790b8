"""Session defaults and the shared scratch location."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings the package relies on: UTC month boundaries, ANSI casts, and AQE
# for runtime re-planning (partition coalescing, skew-join splitting and
# size-checked broadcast conversion).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small shuffles of wide rows (53 measures) are CPU-heavy per row: let AQE
    # keep parallelism down to 64 KB partitions instead of the 1 MB floor.
    # Large shuffles are sized by the advisory partition size as usual.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    # A workload cycling through many wide plans (53 measures) keeps their
    # generated code: compiling one wide stage costs 100-350 ms.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Remove checkpoint files once the DataFrames that wrote them are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def cluster_conf(
    total_cores: int, input_bytes: int, max_partitions: int = 100_000
) -> dict[str, str]:
    """Sizing for a cluster run: task-sized input splits and shuffle partitions.

    * input splits of 256 MB keep a scan task's decoded batch well inside
      executor memory;
    * the initial shuffle partition count gives about 1 GB per reducer for
      the largest possible shuffle (the input itself), at least 3 waves of
      tasks and at most ``max_partitions`` (map-status metadata grows with
      maps x reducers; raise it with the driver's memory); AQE then coalesces small shuffles to 128 MB
      partitions and splits skewed ones (5x the median and over 256 MB).
      The package's own shuffles follow partial aggregation and are small.
    """
    split = 256 * 1024 * 1024
    partitions = min(max_partitions, max(3 * total_cores, -(-input_bytes // (4 * split))))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(split),
        # Broadcast only small sides; AQE re-checks the real size at run time.
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def build_session(master: str | None = None, app: str = "enrolmart", **conf) -> SparkSession:
    """Session with the package defaults; ``conf`` overrides (e.g. ``cluster_conf``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, registered with the context.

    The deployment sets it to a filesystem that every executor reaches.  A
    folder is never invented here: one that only the driver sees would lose
    intermediate data on a cluster, so an unset setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a shared folder when the session is built")
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_SCRATCH: list[str] = []
_TABLES: list[tuple[str, str]] = []


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint root (removed by ``clear_scratch``)."""
    path = f"{checkpoint_root(spark)}/enrolmart/{label}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def scratch_name(kind: str, label: str) -> str:
    """A unique name for a temporary ``table`` or ``view`` (dropped by ``clear_scratch``)."""
    name = f"enrolmart_{label}_{uuid.uuid4().hex[:10]}"
    _TABLES.append((kind, name))
    return name


def scratch_family(label: str, kinds: dict[str, str]) -> str:
    """A unique prefix of tables and views ``<prefix>_<suffix>`` (dropped by ``clear_scratch``)."""
    name = f"enrolmart_{label}_{uuid.uuid4().hex[:10]}"
    _TABLES.extend((kind, f"{name}_{suffix}") for suffix, kind in kinds.items())
    return name


def note_views(names) -> None:
    """Temporary views for ``clear_scratch`` to drop."""
    _TABLES.extend(("view", n) for n in names)


def clear_scratch(spark: SparkSession) -> None:
    """Drop the tables, views and folders that queries made for their results.

    DataFrames are lazy, so a query cannot remove what its caller has yet to
    read; the caller does, once the results are consumed.
    """
    while _TABLES:
        kind, name = _TABLES.pop()
        spark.sql(f"DROP {kind.upper()} IF EXISTS {name}")
    while _SCRATCH:
        remove(spark, _SCRATCH.pop())


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop filesystem of ``path`` (any URI scheme)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; an error when the filesystem refuses."""
    fs, p = _fs(spark, source)
    fs.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(target).getParent())
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (metadata only, no data read)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path`` (metadata only)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def read_text(spark: SparkSession, path: str) -> str:
    """The text of one small file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create one small file; False if it is there already."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    fs.mkdirs(p.getParent())
    try:
        stream = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def listing(spark: SparkSession, path: str) -> tuple:
    """(name, bytes, modification time) of the files at ``path``: changes when the data does."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return ()
    return tuple(
        sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))
    )
