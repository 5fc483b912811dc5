"""Community analytics on Spark: snapshots in, Bronze/Silver/Gold and insights out.

Every public function takes DataFrames and returns DataFrames, so the pieces chain with
``DataFrame.transform``. Nothing is collected on the way.
"""

from plaza.session import build_session, configure

__all__ = ["build_session", "configure"]
