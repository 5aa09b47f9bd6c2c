"""martlake: e-commerce catalogue, sales and review-feedback processing on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from native Spark
expressions and aggregates, so Catalyst plans it and executors run it at scale.
"""

__version__ = "0.1.0"
