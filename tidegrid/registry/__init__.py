"""One registered query per inventory item, with its SQL oracle where SQL can express it."""

from tidegrid.registry.core import ORACLES, QUERIES
from tidegrid.registry import lake, learning, relational, streams  # noqa: F401  (registration)

__all__ = ["ORACLES", "QUERIES"]
