"""Scalar column expressions."""

from churnlens.functions.scalar import *  # noqa: F401,F403
