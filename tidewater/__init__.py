"""tidewater: ingest, check and reshape data with Spark SQL and Structured Streaming.

Every public operator takes DataFrames (batch or streaming) and returns DataFrames;
planning and execution are left to Catalyst, AQE and the streaming engine.
"""

from tidewater.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
