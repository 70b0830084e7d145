"""Keyed, versioned cell tables and event text on PySpark.

Every operator is a DataFrame transformation: cells live in Parquet, Catalyst
plans the work, and Python runs only where a user function or an ordered fold
needs it.
"""

__version__ = "0.1.0"
