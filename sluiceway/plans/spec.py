"""Flow descriptions and the rules on which combinations make sense."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from sluiceway.operators.governance import CHANGE, LOG
from sluiceway.operators.steps import Step, flag, load_steps
from sluiceway.sources.formats import APPEND, OVERWRITE, UPDATE
from sluiceway.sources.stores import BATCH, STREAM, snake

log = logging.getLogger(__name__)

# Accepted spellings, matched without regard to case.
FLOW_TYPES = {"batch": BATCH, "stream": STREAM}
DATA_TYPES = {"logdata": LOG, "log": LOG, "changedata": CHANGE, "change": CHANGE, "cdc": CHANGE}
OPERATIONS = {"overwrite": OVERWRITE, "append": APPEND, "update": UPDATE}
ONCE = "once"
DEFAULT_TRIGGER = "5 seconds"

KEYS = {
    "flow_type",
    "read_data_type",
    "write_data_type",
    "write_operation",
    "trigger_interval",
    "source",
    "destination",
    "transformation",
    "checkpoint_location",
    "per_batch",
    "growing_schema",
    "order_by",
    "drop_tombstones",
    "spark",
}


def _parse(value: str, spellings: Mapping[str, str], what: str) -> str:
    found = spellings.get(str(value).lower())
    if found is None:
        raise ValueError(f"{what} {value!r} is not known, use one of {sorted(spellings)}")
    return found


@dataclass(frozen=True)
class FlowSpec:
    """What to move from where to where, and how.

    `per_batch` makes a stream treat each micro-batch as static data. That is for custom
    steps with operations Spark has for static data only. `growing_schema` does so too, and lets
    the inferred schema of a stream grow by the fields of each micro-batch. `order_by` names the columns that tell which of two changes
    is the later one, where that is not the offset. `drop_tombstones` leaves deletes out of a
    stream of change data into log data, which otherwise become rows of nulls.
    """

    source: Mapping[str, Any]
    destination: Mapping[str, Any]
    flow_type: str = BATCH
    source_type: str = LOG
    target_type: str | None = None
    operation: str | None = None
    trigger: str = DEFAULT_TRIGGER
    steps: tuple[Step, ...] = field(default=())
    checkpoint: str | None = None
    per_batch: bool = False
    growing_schema: bool = False
    order_by: str | Sequence[str] | None = None
    drop_tombstones: bool = False

    def __post_init__(self) -> None:
        if self.target_type is None:
            object.__setattr__(self, "target_type", self.source_type)
        if self.operation is None:
            object.__setattr__(self, "operation", OVERWRITE if self.flow_type == BATCH else APPEND)
        object.__setattr__(self, "steps", tuple(load_steps(self.steps)))

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> FlowSpec:
        """From a nested mapping; top-level keys may be camelCase or snake_case."""
        settings = {snake(k): v for k, v in config.items()}
        unknown = set(settings) - KEYS
        if unknown:
            raise ValueError(f"unknown keys {sorted(unknown)}, use {sorted(KEYS)}")
        for needed in ("source", "destination"):
            if needed not in settings:
                raise ValueError(f"a flow needs {needed!r}")
        if "spark" in settings:
            log.warning("the section 'spark' is not used: the session is the caller's")
        given: dict[str, Any] = {"source": settings["source"], "destination": settings["destination"]}
        if "flow_type" in settings:
            given["flow_type"] = _parse(settings["flow_type"], FLOW_TYPES, "flow type")
        if "read_data_type" in settings:
            given["source_type"] = _parse(settings["read_data_type"], DATA_TYPES, "data type")
        if "write_data_type" in settings:
            given["target_type"] = _parse(settings["write_data_type"], DATA_TYPES, "data type")
        if "write_operation" in settings:
            given["operation"] = _parse(settings["write_operation"], OPERATIONS, "write operation")
        if "trigger_interval" in settings:
            given["trigger"] = str(settings["trigger_interval"])
        if "checkpoint_location" in settings:
            given["checkpoint"] = settings["checkpoint_location"]
        if "per_batch" in settings:
            given["per_batch"] = flag(settings["per_batch"])
        if "growing_schema" in settings:
            given["growing_schema"] = flag(settings["growing_schema"])
        if "drop_tombstones" in settings:
            given["drop_tombstones"] = flag(settings["drop_tombstones"])
        if "order_by" in settings:
            given["order_by"] = settings["order_by"]
        given["steps"] = tuple(load_steps(settings.get("transformation")))
        return cls(**given)

    @classmethod
    def from_text(cls, text: str) -> FlowSpec:
        """From JSON, or YAML where PyYAML is installed."""
        try:
            config = json.loads(text)
        except json.JSONDecodeError as error:
            try:
                import yaml
            except ImportError:
                raise ValueError("not JSON, and PyYAML is not installed") from error
            config = yaml.safe_load(text)
        if not isinstance(config, Mapping):
            raise ValueError("a flow description is a mapping")
        return cls.from_dict(config)

    @classmethod
    def from_file(cls, path: str) -> FlowSpec:
        with open(path, encoding="utf-8") as stream:
            return cls.from_text(stream.read())

    @property
    def takes_snapshot(self) -> bool:
        """Batch change data into log data: the last value per key."""
        return (
            self.flow_type == BATCH
            and self.source_type == CHANGE
            and self.target_type == LOG
            and self.operation != UPDATE
        )

    def check(self, append_only_target: bool = False) -> None:
        """Raise ValueError for a combination of flow, types and operation that makes no sense."""
        reason = None
        if self.flow_type == STREAM:
            if self.operation == OVERWRITE:
                reason = "a stream cannot overwrite, use a batch flow"
            elif self.source_type == LOG and self.target_type == CHANGE:
                reason = "log data cannot become change data"
            elif self.operation == UPDATE and self.target_type == CHANGE:
                reason = "a stream cannot update change data, append to it"
        elif self.operation == APPEND and self.source_type == CHANGE and self.target_type == LOG:
            reason = "a snapshot replaces its target, it cannot be appended"
        if reason is None and self.operation == UPDATE:
            if self.source_type == LOG:
                reason = "log data has no key to update by"
            elif append_only_target and self.target_type == LOG:
                reason = "a topic cannot be updated, append change data to it"
        if reason:
            flow = f"{self.flow_type} {self.source_type} to {self.target_type} {self.operation}"
            raise ValueError(f"{flow}: {reason}")
