"""Customer analytics as composable Spark DataFrame operators.

Every operator takes a DataFrame (plus parameters) and returns a DataFrame, so
it works with ``df.transform`` and keeps the whole plan visible to Catalyst.
"""

from cohortry.session import build_session, scratch_path, settle, shared_folder

__all__ = ["build_session", "scratch_path", "settle", "shared_folder"]
