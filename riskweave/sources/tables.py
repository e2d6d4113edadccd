"""Reading inputs, writing results, and cutting lineage through the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskweave.sources.files import Folder
from riskweave.sources.publish import Publication

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_PART = r"""\[((?:[^\]]|\]\])+)\]|`((?:[^`]|``)+)`|"((?:[^"]|"")+)"|([^.\[\]`"\s]+)"""
_NAME = re.compile(rf"(?:{_PART})(?:\.(?:{_PART}))*")


def catalog_name(name: str) -> str:
    """A name of one to three parts, plain or in brackets, quotes or backticks, as Spark has it.

    What stands in brackets is one part, dots included.
    """
    if not _NAME.fullmatch(name):
        raise ValueError(f"{name!r} is not a table name")
    parts = []
    for bracketed, ticked, quoted, plain in re.findall(_PART, name):
        part = (bracketed.replace("]]", "]") or ticked.replace("``", "`")
                or quoted.replace('""', '"') or plain)
        parts.append("`" + part.replace("`", "``") + "`")
    if len(parts) > 3:
        raise ValueError(f"{name!r} has more than three parts")
    return ".".join(parts)


def is_path(name: str) -> bool:
    """Anything with a slash outside brackets and quotes is a folder of parquet files."""
    return "/" in re.sub(r"""\[[^\]]*\]|`[^`]*`|"[^"]*\"""", "", name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a parquet folder: in its present version if it is published."""
    if not is_path(name):
        return spark.table(catalog_name(name))
    parent, table = name.rstrip("/").rsplit("/", 1)
    return spark.read.parquet(Publication(spark, parent).tables().get(table, name))


def write_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table or a parquet folder, so a rerun gives the same result."""
    writer = df.write.mode("overwrite").format("parquet")
    if is_path(name):
        writer.save(name)
    else:
        writer.saveAsTable(catalog_name(name))


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only a local session without the setting gets a temporary folder of its own; a cluster
    without it is an error because executors do not share a local disk.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskweave-"))
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back; it goes when the driver ends.

    Lost executors then cost a re-read instead of the scan behind the frame, and a join
    with the frame sees its true size and a plain scan, which lets adaptive execution
    broadcast it when small and split hot keys of the other side when not.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    Folder(df.sparkSession, path).delete_on_exit()
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
