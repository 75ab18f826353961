"""Sharded record streams on Spark: plain functions from DataFrame to DataFrame."""

from .config import Limits, Position

__all__ = ["Limits", "Position"]
