"""Risk adjustment for Medicare claims as Spark DataFrame jobs.

``operators`` holds pure DataFrame -> DataFrame steps, ``plans`` chains them into
whole runs, ``sources`` reads, cleans and writes tables, ``functions`` holds shared
column expressions, ``models`` the fixed values of the two model versions.
"""
