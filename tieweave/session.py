"""Session settings and durable cuts of long plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tieweave-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path in its form."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, jpath = hadoop_path(spark, path)
    return filesystem.exists(jpath)


def remove_path(spark: SparkSession, path: str) -> None:
    filesystem, jpath = hadoop_path(spark, path)
    filesystem.delete(jpath, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    filesystem, jpath = hadoop_path(spark, path)
    if not filesystem.exists(jpath):
        return []
    return [status.getPath().getName() for status in filesystem.listStatus(jpath)]


# A narrow table of at most this many counted rows is sent to every executor.
BROADCAST_ROWS = 1_000_000


def sent_whole(df: DataFrame, rows: int) -> DataFrame:
    """Broadcasts ``df`` when its counted ``rows`` allow it; Spark decides otherwise."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def kept_apart(df: DataFrame) -> DataFrame:
    """Keeps a table that grows with the input from being sent through the driver, however
    small its files look: it is joined by merging."""
    return df.hint("merge")


def partitions_for(spark: SparkSession, rows: int, most: int = 2_000_000) -> int:
    """Partitions for counted rows, as of a kept edge table: enough for all cores once
    that pays off, and never more than ``most`` rows in one."""
    busy = min(spark.sparkContext.defaultParallelism, -(-rows // 20_000))
    return max(1, busy, -(-rows // most))


class RoundTables:
    """Tables written between the rounds of an iterative job.

    Writing a round cuts the plan and survives lost executors; reading it back
    gives Spark the real size, so small rounds are broadcast and large ones are
    not. ``finish`` keeps only the table that the caller returns.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = scratch_path(spark, label)
        self.written = 0
        self.tables: list[tuple[DataFrame, str]] = []

    def write(self, df: DataFrame, **measures) -> tuple[DataFrame, dict]:
        """Writes ``df`` and returns it with the measures taken on the way."""
        path = f"{self.root}/{self.written:04d}"
        self.written += 1
        schema = df.schema
        watch = Observation()
        named = [column.alias(name) for name, column in measures.items()]
        df.observe(watch, F.count(F.lit(1)).alias("rows"), *named).write.parquet(path)
        table = self.spark.read.schema(schema).parquet(path)
        self.tables.append((table, path))
        return table, watch.get

    def drop(self, table: DataFrame | None) -> None:
        """Deletes one written table that no later plan reads."""
        for known, path in list(self.tables):
            if known is table:
                remove_path(self.spark, path)
                self.tables = [entry for entry in self.tables if entry[0] is not table]

    def finish(self, *kept: DataFrame) -> None:
        """Deletes every written table but ``kept``."""
        for table in [known for known, _ in self.tables if not any(known is k for k in kept)]:
            self.drop(table)


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    table, _ = RoundTables(df.sparkSession, label).write(df)
    return table


def numbered(ids: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Every different ``key`` with a number ``n`` below their count, and that count."""
    numbers, taken = RoundTables(ids.sparkSession, "numbers").write(
        ids.distinct().select(key, F.monotonically_increasing_id().alias("n"))
    )
    # Such ids hold the number of a partition above 33 bits; each gets a place for its rows.
    part = F.shiftright("n", 33).cast("int")
    sizes = {row["part"]: row["count"] for row in numbers.groupBy(part.alias("part")).count().collect()}
    places = [sum(sizes.get(i, 0) for i in range(end)) for end in range(max(sizes, default=0) + 1)]
    place = F.get(F.lit(places).cast("array<long>"), part)
    number = place + F.col("n").bitwiseAND(F.lit((1 << 33) - 1))
    return numbers.select(key, number.cast("int" if taken["rows"] < 1 << 31 else "long").alias("n")), taken["rows"]


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tieweave")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
