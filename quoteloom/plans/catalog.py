"""All named queries; importing the modules registers them."""

from . import cleaning, drift_side, entities, feeds, jobs, read_side, run_side, state  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
