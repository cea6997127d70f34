"""Stream flows."""

from sluiceway.streaming.runner import checkpoint_of, set_trigger, start_stream

__all__ = ["checkpoint_of", "set_trigger", "start_stream"]
