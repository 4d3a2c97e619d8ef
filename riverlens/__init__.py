"""riverlens: sampling-quality analytics as Spark DataFrame jobs.

Every operator is a function from DataFrames to DataFrames.  Row-wise work
stays in Catalyst expressions (whole-stage codegen); grouping, ranking and
joins are expressed declaratively so the optimizer can push filters and
prune columns down to the parquet scan.
"""

__version__ = "0.1.0"
