"""cumulo: analytics building blocks for tables and streams on Spark.

Every block is a DataFrame -> DataFrame function built from Catalyst
operators (joins, grouping, windows, generators). Incremental blocks
have a full-rebuild twin; tests hold the two to each other.
"""

__version__ = "0.1.0"
