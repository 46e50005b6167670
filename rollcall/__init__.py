"""Staff attendance and approvals analytics on Spark."""

from rollcall.settings import Settings, prepare_session

__all__ = ["Settings", "prepare_session"]
