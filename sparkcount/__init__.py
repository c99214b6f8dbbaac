"""sparkcount: counting on graphs, text and integer streams with Spark DataFrames.

Every operator is a function DataFrame -> DataFrame built from Spark SQL
joins, aggregates, windows and Structured Streaming.  Random choices come from
explicit seeds so every result can be checked against plain SQL.
"""

from sparkcount.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
