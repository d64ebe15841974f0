"""tidewatch: feature-drift detection for model request logs on Spark.

Log lines (tables or streams) are parsed with Spark SQL expressions into
per-model feature vectors, online drift detectors run per model (and per
feature) as window plans or ordered stream folds, and the alarms become a
latched, warm-up-aware drift probability per model and batch.
"""

__version__ = "0.1.0"
