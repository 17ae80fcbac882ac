"""churnlens: user-retention analytics as Spark DataFrame / ML / Streaming jobs.

Every operator takes and returns DataFrames keyed by ``username``; nothing whose
size grows with the number of users passes through the driver.
"""

from churnlens.schemas import FEATURE_COLUMNS, FINAL_FEATURES  # noqa: F401

__all__ = ["FEATURE_COLUMNS", "FINAL_FEATURES"]
