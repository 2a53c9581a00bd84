"""bellwire: market-news analytics on PySpark DataFrames."""

from bellwire.session import build_session

__all__ = ["build_session"]
