"""Importing the modules registers their queries."""

from . import features, lake, months, relational, scalar  # noqa: F401
from .registry import CHECKS

__all__ = ["CHECKS"]
