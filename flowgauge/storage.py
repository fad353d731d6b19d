"""Written intermediate tables and size-checked lookups."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
HOT_ROWS = 5_000_000
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, as the cluster names it.

    A machine-local folder is only ever chosen in local mode, where no setting
    was given and the driver is the only machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="flowgauge-")
    return _LOCAL[context.applicationId]


def stored_at(df: DataFrame) -> str:
    """Write ``df`` under a new name in the shared folder and return the path."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    return df.sparkSession.read.schema(df.schema).parquet(stored_at(df))


def fresh_folder(spark: SparkSession) -> str:
    """A new empty folder in the shared one, by its full URI, for files that tasks write."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}")
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(place)
    return system.makeQualified(place).toString()


def slots(spark: SparkSession) -> int | None:
    """Tasks that the cluster runs at once; None where executors come and go."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return None
    context = spark.sparkContext._jsc.sc()
    return context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()) or None


def lanes_at_once(spark: SparkSession) -> int:
    """Shuffle partitions, but no more than tasks that run at once."""
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(lanes, slots(spark) or lanes)


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` holds at most ``rows`` rows; every task counts its own."""
    return df.agg(F.count(F.lit(1))).first()[0] <= rows


def lookup(big: DataFrame, small: DataFrame, on: list[str], how: str = "left",
           rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join ``big`` to a table with unique ``on`` keys without hot-key tasks.

    A small side under the row bound is broadcast. For a larger one, keys with
    more than ``hot_rows`` rows in ``big`` are counted out first; there can be
    only few of them, so their entries are broadcast and their rows stay where
    they are. The other keys are joined by a shuffle.
    """
    if fits(small, rows):
        return big.join(F.broadcast(small), on, how)
    if big.isStreaming:
        return big.join(small, on, how)
    heavy = written(big.groupBy(*on).count().filter(F.col("count") > hot_rows).select(*on))
    if not fits(heavy, rows):
        raise ValueError("too many hot keys to broadcast; raise hot_rows")
    marked = big.join(F.broadcast(heavy.withColumn("_hot", F.lit(True))), on, "left")
    # A missing key matches nothing: it goes the way that does not shuffle.
    stays = F.coalesce("_hot", F.lit(False))
    for key in on:
        stays = stays | F.col(key).isNull()
    marked = marked.withColumn("_hot", stays)
    few = small.join(F.broadcast(heavy), on, "left_semi")
    hot = marked.filter("_hot").drop("_hot").join(F.broadcast(few), on, how)
    rest = marked.filter("NOT _hot").drop("_hot").join(small, on, how)
    return hot.unionByName(rest)


def literal_map(values: dict) -> Column:
    """A small fixed dictionary as a MAP literal."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
