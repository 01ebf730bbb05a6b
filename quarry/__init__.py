"""quarry: DataFrame-first analytics operators on Spark.

Every public operator is a function ``DataFrame(s) -> DataFrame`` built from
the DataFrame / SQL / ML / Structured Streaming APIs.  Nothing is collected to
the driver except scalar parameters (a count, a fitted model's small state).
"""

from quarry.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
