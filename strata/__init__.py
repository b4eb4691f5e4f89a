"""strata — layered tabular preparation, profiling and modelling on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from the
DataFrame API; statistics that must be known before rows are rewritten
(medians, fences, modes) are computed as distributed aggregates and applied
through scalar subqueries or joins, never through the driver.
"""

from strata.session import ensure_checkpoint_dir, get_session

__all__ = ["ensure_checkpoint_dir", "get_session"]
