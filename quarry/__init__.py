"""quarry: DataFrame-in / DataFrame-out analytics and ML operators on Spark.

Sub-packages
------------
sources    scans, file sources, model / matrix persistence
functions  column expressions (math, arrays, text, hashing)
operators  profiling, splits, joins, aggregates, windows, features,
           metrics, models, clustering, dimensionality reduction
plans      composed end-to-end jobs and the query registry
streaming  incremental (foreachBatch) training and streaming aggregates
"""

__version__ = "0.1.0"
