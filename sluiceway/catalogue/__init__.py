"""Named queries over the given tables, one or more per operator."""

from sluiceway.catalogue import change_data, flows, governance  # noqa: F401
from sluiceway.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
