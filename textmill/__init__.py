"""textmill: text-analysis jobs as Spark DataFrames.

Manifests name documents and the analysis wanted for each; every task ends as
one result row.  All operators take DataFrames and return DataFrames.
"""

from textmill.session import build_session

__all__ = ["build_session"]
