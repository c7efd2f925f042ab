"""Small helpers that the corpus operators share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Exactly the six characters that the contracts call white space.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; in local mode, as in tests, one of its own where none is set."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = getattr(spark.sparkContext, "_quorumdf_scratch", None)
        if path is None:
            path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
            spark.sparkContext._quorumdf_scratch = path
    return path.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone at exit; the folder is scratch
        pass


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    This cuts the lineage and survives lost executors: the files are in the
    folder that all executors share, never in a machine-local one.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/quorumdf-{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(taken: list[str], want: str) -> str:
    """``want``, with underscores behind it until no column has the name (case aside, as Spark compares)."""
    low = {c.lower() for c in taken}
    while want.lower() in low:
        want += "_"
    return want


def whole_text(col="text"):
    """The text, null as the empty string."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
