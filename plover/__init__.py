"""plover: a Spark-native engine for preparing, splitting, scoring and gating
binary-outcome recommendation data.

Every operator takes and returns pyspark DataFrames and is expressed with the
DataFrame/SQL API so Catalyst can prune, push down and plan it.
"""

__version__ = "0.1.0"
