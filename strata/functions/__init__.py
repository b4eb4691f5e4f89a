"""Column expressions (row-wise, JVM-side, no UDFs)."""
from strata.functions.expressions import *  # noqa: F401,F403
