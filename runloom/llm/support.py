"""Helpers that several operators of this folder share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
LETTERS_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS_LOWER = LETTERS_UPPER.lower()
#: The white space of the contracts: blank and \x09 to \x0D.
BLANKS = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    A folder of this machine is set only where the session names none, as in tests.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        folder = spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set(CHECKPOINT_CONF, folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    The rows survive lost executors, later reads prune columns and rows, and the plan
    of what follows starts at the files.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and all other characters as they are."""
    return F.translate(text, LETTERS_UPPER, LETTERS_LOWER)


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")
