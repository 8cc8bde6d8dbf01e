"""Whole jobs."""

from .publish import publish
from .refresh import Tables, refresh

__all__ = ["Tables", "publish", "refresh"]
