"""Table replication and change capture on Spark."""

from tablesync.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
