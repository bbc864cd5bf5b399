"""Stage tables: cut lineage by writing to the folder every executor shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few short columns that one broadcast may hold.
FEW_ROWS = 500_000


def shared_root(spark: SparkSession) -> str:
    """Folder for stage tables: ``spark.checkpoint.dir`` as the session has it.

    A cluster must name one. Only a master within one process, as in tests, falls
    back to a temporary folder, which goes when the program ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="rankloom-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/rankloom/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    The plan above it starts from files, so a lost executor re-reads them
    instead of re-running the job. The optimizer takes the files' size for
    that of the rows; see ``shuffled`` for rows that files hold in much less.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that sends none of its sides to the driver.

    Files hold repeated texts in a small part of the memory that their rows take,
    so by the size of its files a staged table is broadcast that no driver can hold.
    """
    return df.hint("merge")


def counted(df: DataFrame) -> DataFrame:
    """A staged table of a few short columns for a join: broadcast if it has few rows, else ``shuffled``."""
    return F.broadcast(df) if df.count() <= FEW_ROWS else shuffled(df)
