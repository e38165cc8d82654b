"""tabula — Spark-native relational feature engineering and scoring.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects and is
built from Catalyst expressions (``pyspark.sql.functions``), so filters and
projections reach the parquet scan and aggregations run with partial
(map-side) combine.  Driver round-trips happen only for *schema decisions*
whose size is bounded by the number of columns or category levels (one-hot
levels, near-zero-variance drop lists, correlation / PCA matrices).

Sub-packages
------------
sources    table scans, score files, sinks, lineage cuts
functions  column expressions: IEEE division, right-closed bins, row-wise
           statistics, aggregate bundles, column selectors
operators  DataFrame -> DataFrame operators (roll-ups, group statistics,
           encoders, column filters, imputation, PCA, kNN, split, trainer,
           blending)
plans      analog entities over the provided tables, the query catalog and
           the end-to-end pipeline recipe
"""

__version__ = "0.1.0"
