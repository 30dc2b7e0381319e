"""The query interface: one object per subject over a set of canonical tables.

    p = Platform.of_lake(Lake(spark, "/data"))
    p.elections.results(year=2024, office="senate", state="PA")
    p.economics.labor(state="PA", as_of="2024-10-01")
    p.features.build(2024, "senate", "2024-10-15")

Everything returned is a lazy frame; ``as_of`` restricts it to rows published on
or before that day.
"""

from .platform import Platform

__all__ = ["Platform"]
