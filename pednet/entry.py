"""Query registry of the library's own operators: name -> (spark, sf_dir) -> DataFrame, and the same in SQL."""

from __future__ import annotations

from pednet.plans import evidence, more, nearby, places, streams, times  # noqa: F401  register their queries
from pednet.plans.catalogue import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
