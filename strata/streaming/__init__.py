"""Incremental refresh and stream scoring."""
from strata.streaming.incremental import *  # noqa: F401,F403
