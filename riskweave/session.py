"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Splits hot keys and picks join sides and partition counts from measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes of bytecode.  The rules of a model
    # make one fused method longer than that; with this limit Spark evaluates such a stage
    # operator by operator, in methods that are compiled: about 20 times faster when measured.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Buckets of one sorted file each are read in their order, so that a join need not sort.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that the user has not set.

    For whoever builds the session; no function of the library changes a session.
    """
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark
