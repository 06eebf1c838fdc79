"""Scalar column helpers (all built-in Spark expressions)."""
from millrace.functions.scalar import *  # noqa: F401,F403
