"""millrace: analytics operators written directly for Apache Spark through PySpark."""

from millrace.session import build_session, configure

__all__ = ["build_session", "configure"]
