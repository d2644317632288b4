"""What the operators of this package share: tables, stored intermediates, Arrow batches."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that Python receives at once. Small, because a text may be very long.
ARROW_ROWS = 512
#: What separates words where nothing else is said (SQL regular expression).
BLANKS = r"[\x20\x09-\x0D]+"

_written: list[str] = []
_local: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows of an Arrow batch, so a Python worker's memory does not follow
    the length of the texts times ten thousand. A smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = int(spark.conf.get(key))
    if held <= 0 or held > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``. Only a session
    in one process may do without the setting."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="verdance-llm-"))
    return f"file://{_local[0]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: lineage ends there, a lost
    executor costs no recomputation, and values drawn from row numbers stay as they were.
    The files go when ``forget`` is called or the driver ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path  # type: ignore[attr-defined]
    return back


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    if path in _written:
        _written.remove(path)


def forget(*frames: DataFrame) -> None:
    """Deletes what ``stored`` wrote for these frames. Only for frames nothing lazy reads any more."""
    for df in frames:
        path = getattr(df, "_stored_at", None)
        if path:
            _delete(df.sparkSession, path)


@atexit.register
def _forget_all() -> None:
    spark = SparkSession.getActiveSession()
    for path in list(_written):
        with contextlib.suppress(Exception):
            _delete(spark, path)


def fresh(taken: list[str], name: str) -> str:
    """A column name like ``name`` that is not taken."""
    used = {x.lower() for x in taken}
    while name.lower() in used:
        name += "_"
    return name


def row_id() -> Column:
    """A number for each row of one scan. Only for rows that are stored before the number
    is read twice."""
    return F.monotonically_increasing_id()


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n. Null where the id is null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))
