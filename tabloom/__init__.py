"""Feature engineering, leakage-safe encoding and model blending on Spark.

Every operator takes and returns DataFrames. Rows are identified by a key
column, never by position, so nothing depends on partitioning or row order.
"""

__version__ = "0.1.0"
