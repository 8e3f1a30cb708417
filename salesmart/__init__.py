"""salesmart: sales-mart and lakehouse analytics on Spark DataFrames.

* ``sources``   - Parquet table sets, landed CSV and JSON, writers, declared schemas, bucketed layout
* ``functions`` - exact money measures, relative time filters and bins, text helpers
* ``operators`` - joins and key audits, roll-ups and top-k, profiles, type 2 dimensions,
                  change logs (versioned tables), key batches
* ``plans``     - the registered queries over the driver tables, each with its SQL oracle
* ``streaming`` - the time-bin roll-up as a Structured Streaming query
* ``session``   - session settings and the shared folder for checkpoints and tables
"""

__version__ = "0.1.0"
