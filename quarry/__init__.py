"""quarry: Spark-native data preparation, feature, learning and evaluation operators.

Every operator is a plain function over Spark DataFrames.  Counts, gradients and
split scores are Spark aggregates; only model-sized arrays reach the driver.
"""

__version__ = "0.1.0"
