"""vittles: a Spark-native food and nutrient scoring engine.

Every operator is a function over DataFrames whose column names are
arguments, so it runs on any table with the right shape.
"""

__version__ = "0.1.0"
