"""foldwise: leak-aware multi-target tabular regression on Spark.

Every row-level step is a DataFrame / SQL / pyspark.ml plan; only bounded
aggregates (per-feature statistics, p x p Gram matrices, per-fold metrics,
size histograms) ever reach the driver.
"""

__version__ = "0.1.0"
