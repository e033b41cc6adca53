"""Session settings and lineage cuts shared by all operators."""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that results depend on; everything else is the cluster's choice.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def apply_semantics(spark: SparkSession) -> SparkSession:
    """Set what results depend on, and nothing that only affects speed."""
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(master: str = "local[8]", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster use the cluster's own."""
    spark = (
        SparkSession.builder.master(master)
        .appName("evigrade")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    return apply_semantics(spark)


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is what spark.checkpoint.dir names.  Only where that is unset and the master is
    local, as in tests, a temporary folder is made, and removed when Python
    ends; a cluster without the setting is an error, as no folder is known to be shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        made = tempfile.TemporaryDirectory(prefix="evigrade-")
        _own_dirs[app] = f"file://{made.name}"
        atexit.register(made.cleanup)
    return _own_dirs[app]


_cuts: list[str] = []


#: Rows of a row group of a table with long texts: a reader holds no batch larger than a row group.
WIDE_ROWS = 128


def cut(df: DataFrame, wide: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The result has no lineage: an executor that is lost later costs no
    recomputation of what stands before the cut.  The files go with release()
    or when Python ends.  wide: its rows are whole pages; a reader takes 4,096 rows of a row group
    at once, so row groups are short.  Their bytes are no bound, as a writer counts them compressed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/evigrade-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    options = {"parquet.block.row.count.limit": str(WIDE_ROWS)} if wide else {}
    df.write.mode("error").options(**options).parquet(path)
    at_release(path)
    return spark.read.schema(df.schema).parquet(path)


def at_release(path: str) -> None:
    """Have release() remove a folder under shared_dir()."""
    _cuts.append(path)


def cuts() -> list[str]:
    """The folders that release() would remove now."""
    return list(_cuts)


def release(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Remove the tables that cut() wrote and other intermediate folders, all or some; their readers must have ended.

    Shuffle files of tables that nobody holds any more go with them.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in cuts() if paths is None else paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
        if name in _cuts:
            _cuts.remove(name)
    gc.collect()
    jvm.System.gc()


@atexit.register
def _release_at_exit() -> None:
    with contextlib.suppress(Exception):
        if _cuts and (spark := SparkSession.getActiveSession()) is not None:
            release(spark)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables under a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, heavy: bool = False) -> DataFrame:
    """df over all cores, where its scan has fewer partitions than there are cores.

    A table of one small file is one task, whatever the work for each row; tables of
    many files or splits are left as they are.  heavy: so much work for each row that
    a table of fewer files than cores is dealt too, as one row group may be all that a file's splits hold.
    """
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    few = parts < cores or (heavy and len(df.inputFiles()) < cores)
    return df.repartition(max(cores, parts)) if few else df
