"""Flow descriptions and how they run."""

from sluiceway.plans.flow import FlowReport, delete_target, run, run_batch, shape
from sluiceway.plans.spec import FlowSpec

__all__ = ["FlowReport", "FlowSpec", "delete_target", "run", "run_batch", "shape"]
