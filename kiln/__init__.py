"""kiln: feature preparation, distributed statistics, classic learners and
sequence/text preparation as Spark DataFrame plans.

Every public operator takes a DataFrame (plus parameters) and returns a
DataFrame, a fitted ``pyspark.ml`` model, or a tiny k-row parameter table.
Work runs on built-in Spark expressions; nothing unbounded is collected.
"""

__version__ = "0.1.0"
