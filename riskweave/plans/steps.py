"""Steps of a run that are written once and taken up by a rerun.

A step's rows go to a folder of the run, and a manifest entry is made when all are there.  Its
key is taken from the plan behind the rows and from the files that the plan reads (paths, sizes
and times of change), so a rerun over the same inputs, rules and dates finds the step and does
not go back to the claims, while a changed input, year or rule gives another key.

Without steps a run is one lazy plan and starts no job before its result is used.  With steps
each writes its rows when the run is put together; that is their only action.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from riskweave.functions.counting import Counts
from riskweave.sources.files import Folder

MANIFEST = "_steps"
#: Leaves of a plan whose rows follow from the plan's text.
_STATED = {"Range", "OneRowRelation"}
_WIDE = {"spark.sql.debug.maxToStringFields": "100000", "spark.sql.maxMetadataStringLength": "100000"}


def _plan_text(df: DataFrame) -> str:
    """The analyzed plan in full, without the numbers that Spark gives anew each time."""
    conf = df.sparkSession.conf
    before = {name: conf.get(name, None) for name in _WIDE}
    try:
        for name, value in _WIDE.items():
            conf.set(name, value)
        text = df._jdf.queryExecution().analyzed().toString()
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)
    # A watched frame is the same frame; its observer has a new name each time.
    text = "\n".join(line for line in text.splitlines() if "CollectMetrics" not in line)
    text = re.sub(r"\blambda (\w+?)_\d+#", r"lambda \1#", text)
    return re.sub(r"#\d+L?", "", text)


def _files(df: DataFrame) -> list[str] | None:
    """One entry for each table of files in the plan; None when other leaves hold rows."""
    jvm = df.sparkSession.sparkContext._jvm
    nil = getattr(getattr(jvm.scala.collection.immutable, "Nil$"), "MODULE$")
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName().rstrip("$")
        if kind in _STATED:
            continue
        relation = leaf.relation() if kind == "LogicalRelation" else None
        if relation is None or relation.getClass().getSimpleName() != "HadoopFsRelation":
            return None
        found.append(_listing(relation, nil))
    return found


def _listing(relation, nil) -> str:
    """Digest of the names, sizes and times of change of all files."""
    text = relation.location().listFiles(nil, nil).toString()
    return hashlib.sha256(re.sub(r"access_time=\d+", "", text).encode()).hexdigest()


def plan_key(df: DataFrame) -> str | None:
    """Key of the rows that a plan gives, or None when it reads rows that have no name."""
    files = _files(df)
    if files is None:
        return None
    return hashlib.sha256("\n".join([_plan_text(df), *files]).encode()).hexdigest()[:24]


class Steps:
    """The steps of one run, or of runs over the same inputs, in a folder that executors share.

    ``taken`` and ``written`` name the steps found and made, in order.  A frame built in the
    driver's memory has no lasting name: a step that reads one is written anew each time.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = Folder(spark, folder)
        self.taken: list[str] = []
        self.written: list[str] = []

    def keep(self, df: DataFrame, name: str, counts: Counts | None = None) -> DataFrame:
        """The frame's rows, from the folder.

        What ``counts`` watches in the frame is noted in the manifest for reruns.
        """
        key = plan_key(df)
        step = f"{name}-{key or uuid.uuid4().hex}"
        entry, path = f"{MANIFEST}/{step}.json", f"{self.folder.path}/{step}"
        if key and self.folder.exists(entry):
            self.taken.append(name)
            described = json.loads(self.folder.read(entry))
            if counts is not None:
                counts.forget()
                counts.add(described["counts"])
        else:
            df.write.mode("overwrite").parquet(path)
            described = {
                "step": name,
                "schema": json.loads(df.schema.json()),
                "counts": counts.settle() if counts is not None else {},
            }
            self.folder.create(entry, json.dumps(described), replace=True)
            self.written.append(name)
        schema = StructType.fromJson(described["schema"])
        return self.spark.read.schema(schema).parquet(path)

    def clear(self) -> None:
        self.folder.delete()


def kept(
    steps: Steps | None, df: DataFrame, name: str, counts: Counts | None = None
) -> DataFrame:
    return df if steps is None else steps.keep(df, name, counts)
