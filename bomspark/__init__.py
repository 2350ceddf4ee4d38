"""bomspark: bill-of-materials / engine-configuration analytics on Spark.

Every stage is a ``DataFrame -> DataFrame`` function built from native Spark
expressions, so a whole run is one lazy logical plan that Catalyst and AQE
optimise end to end.  Sub-packages:

* ``sources``   - landing-folder scans, delimiter detection, typed readers,
                  the ingest normalizers and the test-table mappings.
* ``functions`` - column expressions (trim, keys, period-from-file-name, ...).
* ``operators`` - joins, roll-ups, top-1-per-group, audits, diagnostics.
* ``sinks``     - CSV / Parquet writers, partitioned and year-ordered exports.
* ``plans``     - the composed report (``run_workflow``) and the query registry.
* ``streaming`` - exactly-once incremental ingest of daily landing drops.
"""

__version__ = "0.1.0"
