"""tillroll: sales analytics on Spark DataFrames.

Every operator is a plain function ``DataFrame -> DataFrame`` (chainable with
``df.transform``) that stays lazy; only bounded scalars (a row count, a
support threshold) ever reach the driver.

Subpackages
-----------
sources    Parquet/CSV ingest and sinks, profiling, fixture views over the
           test tables.
functions  reusable Column expressions (exact money sums, calendar labels).
operators  cleaning, filters, overview/country/time aggregations, RFM,
           market-basket mining.
plans      multi-step plans: distributed ranking, the cleaning and mining
           pipelines, the query registry and its SQL oracle.
streaming  (empty by design: the workload is batch only, see README).
"""

__version__ = "0.1.0"
