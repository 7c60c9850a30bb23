"""pantry: a Spark-native engine for the data side of a recipe recommender.

Every operator is a function from DataFrames to a DataFrame written with the
DataFrame API / Spark SQL expressions, so Catalyst plans it and the cluster
runs it.  See README.md for the module map.
"""

__version__ = "0.1.0"
