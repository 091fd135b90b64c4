"""streetflow: Spark-native operators for traffic-style sensor streams and dashboard reads.

Every operator is a function ``DataFrame -> DataFrame`` built from Catalyst
expressions, so the same code runs on batch tables and on streaming DataFrames.
"""

from streetflow.session import build_session, ensure_utc, work_dir

__all__ = ["build_session", "ensure_utc", "work_dir"]
