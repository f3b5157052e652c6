"""tarmac — Spark-native flight delay analytics.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL /
DataFrame / ML / Structured Streaming primitives, so Catalyst plans the work and
the cluster executes it.  Sub-packages:

* ``sources``   – readers (raw CSV, curated Parquet, result CSV, prediction
                  batches) and the flight-shaped view over the test tables.
* ``functions`` – column expressions (date parsing, HHMM hours, labels, hashes).
* ``operators`` – ingest/cleaning, summaries, numbering, replay, sampling,
                  evaluation tables.
* ``plans``     – SQL texts, ML pipelines and the catalog of named queries.
* ``streaming`` – Structured Streaming jobs (running averages, model scoring).
* ``sinks``     – writers (curated Parquet, result CSV, replay files, logs).
"""

from tarmac.session import build_session, checkpoint_root, work_dir

__all__ = ["build_session", "checkpoint_root", "work_dir"]
