"""Panel-data preparation on Spark DataFrames.

A *panel* is a long DataFrame keyed by (region, period, category...) with one
double measure. Every operator is a lazy ``DataFrame -> DataFrame`` function
built from native Spark expressions.
"""

__version__ = "0.1.0"
