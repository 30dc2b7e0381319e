"""Point-in-time election analytics on Spark."""

from .api import Platform
from .operators.pit import filter_as_of, latest_as_of
from .storage.lake import Lake

__all__ = ["Lake", "Platform", "filter_as_of", "latest_as_of"]
