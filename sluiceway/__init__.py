"""Data transfer and change data on Spark."""

from sluiceway.plans import FlowReport, FlowSpec, delete_target, run

__all__ = ["FlowReport", "FlowSpec", "delete_target", "run"]
