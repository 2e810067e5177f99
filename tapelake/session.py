"""Session settings and the few helpers that every operator shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders that this process wrote and has not released yet.
_WRITTEN: list[tuple[SparkSession, str]] = []
#: The folder of a session on one machine that names none.
_LOCAL: list[str] = []


def local_session(cores: str = "*", memory: str = "12g") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tapelake")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tapelake-"))
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir.

    Where it is unset, a session of one machine gets a temporary folder of this process; on a
    cluster no folder of one machine is right, so that is an error.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="tapelake-"))
    return _LOCAL[0]


def new_folder(spark: SparkSession) -> str:
    """A name in the shared folder that nothing uses yet; `release` deletes what is written there."""
    path = f"{shared_folder(spark)}/tapelake-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back: the lineage is cut and survives lost executors."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession | None = None) -> int:
    """Delete the tables that queries left in the shared folder, when their results have been read. Returns how many."""
    mine = [(s, p) for s, p in _WRITTEN if spark is None or s is spark]
    for s, p in mine:
        path = s._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(s._jsc.hadoopConfiguration()).delete(path, True)
        _WRITTEN.remove((s, p))
    return len(mine)


def _at_exit() -> None:
    try:
        release()
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass


atexit.register(_at_exit)


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Hint a broadcast only after counting: at most `max_rows` narrow rows, else the planner's shuffle join.

    The count stops at the bound, so a large side costs no full pass.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def fixed(df: DataFrame, **columns) -> DataFrame:
    """`df` with columns computed once a row.

    A projection is merged into the next one and would repeat a long expression at every use;
    a one-element generator is not, at the cost of one array a row.
    """
    for name, c in columns.items():
        df = df.select("*", F.explode(F.array(c)).alias(name))
    return df
