"""Public-works and procurement analytics as Spark DataFrame jobs."""

from canteiro.session import build_session, configure

__all__ = ["build_session", "configure"]
