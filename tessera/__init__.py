"""tessera: Spark-native wealth-management and KYC analytics.

Every public function takes DataFrames (or a session plus a table directory)
and returns a DataFrame. Nothing is collected to the driver; all work is
expressed with built-in Spark SQL expressions so Catalyst can push filters,
prune columns and plan partial aggregation.
"""

from tessera.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
__version__ = "0.1.0"
