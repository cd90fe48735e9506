"""Session helpers: table access and the shared working folder.

Intermediate tables go to the folder named by ``spark.checkpoint.dir`` (shared by all executors), so that the
loss of an executor never loses them.  Only in a local session without that setting a private folder is made.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its checked row count is at most this; beyond, joins are shuffled and salted.
BROADCAST_ROWS = 50_000
#: Number of parts a possibly hot key is split into.
SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_private: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Only a local session may be without it: it gets a private folder, which
    is kept here, as the setting cannot be changed at run time.  On a cluster its absence is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _private.setdefault(spark.sparkContext.applicationId, "")
        if not base:
            base = _private[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="newsloom-")
            atexit.register(shutil.rmtree, base[7:], True)
    return base.rstrip("/")


def stash_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/newsloom/{label}-{uuid.uuid4().hex[:12]}"


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and shares work between branches."""
    path = stash_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(app: str = "newsloom", cores: str | None = None) -> SparkSession:
    """A session for tests and benches on one machine."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEM", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores when it is read from fewer files than there are cores and is small (under 1 GB).

    A small file is one task however much work its rows need; larger inputs have tasks enough and stay as they are.
    Looks at metadata only."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= 1 << 30:
        return df
    files = df.inputFiles()
    return df.repartition(cores) if files and len(files) < cores else df


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; looks at no more than rows + 1 of them."""
    return df.limit(rows + 1).count() <= rows


def join_checked(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join ``big`` with ``small`` (unique on ``on``): broadcast when a row count proves ``small`` to be small,
    otherwise a shuffled join whose hot keys are split into ``SALTS`` parts."""
    if is_small(small):
        return big.join(F.broadcast(small), on, how)
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in big.columns if c not in on] or [F.rand()]), F.lit(SALTS)))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")
