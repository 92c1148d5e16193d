"""Monthly partner reconciliation as Spark jobs.

Every operator takes and returns DataFrames built from native Spark expressions.
"""

__version__ = "0.1.0"
