"""Layered analytics tables on PySpark: raw → staging → marts → enterprise."""

from stratiform.config import EnvConfig

__all__ = ["EnvConfig"]
