"""forgeline: factory machine analytics on Spark DataFrames.

Layers (each a set of pure DataFrame -> DataFrame functions, plus thin I/O):

* ``sources`` / ``sinks``   - lake reads and writes (Parquet, CSV, JSON lines)
* ``streaming``             - Structured Streaming landing of telemetry
* ``operators``             - staging, facts, metrics, business queries,
                              quality checks, alerts, serving data sets
* ``functions``             - column expressions shared by the operators
* ``plans``                 - join strategy, skew-proof ordering, plan checks
* ``jobs``                  - stage runner with run history and lineage
"""

__version__ = "0.1.0"
