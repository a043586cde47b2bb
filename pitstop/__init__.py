"""pitstop: point-in-time customer features, labels, drift and scoring on Spark.

Sub-packages
------------
sources    table schemas, readers, the driver-table adapter and sinks
functions  column-expression helpers (dates, clamps, binning, arrays)
operators  DataFrame operators: features, transform, quality, rollup,
           drift, split, metrics, training and scoring
plans      SQL forms of the feature query and the end-to-end dataset job
streaming  Structured Streaming scoring and windowed drift
"""

__version__ = "0.1.0"
