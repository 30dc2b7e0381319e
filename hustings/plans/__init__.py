"""Registered queries over the derived canonical tables."""

from . import basics, core, explorer, ingest, rules, surface  # noqa: F401
from .registry import QUERIES

__all__ = ["QUERIES"]
