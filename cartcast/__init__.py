"""cartcast: point-in-time customer purchase features and scoring on Spark.

Every public function takes and returns Spark DataFrames; nothing is pulled
to the driver except scalars (fold ids, thresholds, model handles).
"""

from cartcast.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
