"""aisleflow: retail machine-learning data jobs on Spark.

Feature builders (conditional-count pivots, market baskets, text features),
deterministic splits, model fits through ``pyspark.ml``, relational twins of
the models that a SQL engine can re-check, and evaluation tables.  Every
public function takes and returns DataFrames.
"""

__version__ = "0.1.0"
