"""Grouped sums over keyed tables and rule evaluation over records, on Spark."""

from rulegrid.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
