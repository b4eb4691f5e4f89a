"""Readers and writers for layer tables."""
from strata.sources.files import *  # noqa: F401,F403
