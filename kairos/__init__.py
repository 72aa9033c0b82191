"""kairos — dimensional history on Spark.

Plain DataFrame -> DataFrame functions for SCD-2 history, stable surrogate
keys, point-in-time foreign keys, marts, feature tables and data-quality
checks.  Everything runs on Spark's built-in joins, windows and aggregates.
"""

from kairos.session import checkpoint_dir, get_session, scratch_path

__all__ = ["checkpoint_dir", "get_session", "scratch_path"]
