"""Ordered lists of governance steps, as given in a flow description."""

from __future__ import annotations

import importlib
import inspect
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame

from sluiceway.functions.digests import check_algorithm
from sluiceway.operators import governance as g

# Action names, matched without regard to case.
REMOVE = "removecolumns"
DIGEST = "digestcolumns"
REDACT = "redactcolumns"
FILTER = "filterrows"
SAMPLE = "samplerows"
CUSTOM = "class"
NOOP = "noop"
ACTIONS = (REMOVE, DIGEST, REDACT, FILTER, SAMPLE, CUSTOM, NOOP)


@dataclass(frozen=True)
class Step:
    """One governance step. `custom` holds the user's function for the `class` action."""

    name: str
    action: str
    columns: tuple[str, ...] = ()
    options: Mapping[str, Any] = field(default_factory=dict)
    custom: Callable[..., Any] | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "action", self.action.lower())
        object.__setattr__(self, "columns", tuple(self.columns))
        if self.action not in ACTIONS:
            raise ValueError(f"step {self.name!r}: unknown action {self.action!r}, use one of {ACTIONS}")
        if self.action == FILTER and "clause" not in self.options:
            raise ValueError(f"step {self.name!r}: a filter needs the option 'clause'")
        if self.action == DIGEST:
            check_algorithm(str(self.options.get("algo", "md5")))
        if self.action == CUSTOM and self.custom is None:
            raise ValueError(f"step {self.name!r}: no class or function given")

    def apply(self, df: DataFrame, form: str = g.LOG) -> DataFrame:
        options = self.options
        strict = flag(options.get("strict", False))
        if self.action == REMOVE:
            return g.remove_columns(df, self.columns, form=form, name=self.name, strict=strict)
        if self.action == REDACT:
            value = str(options.get("redactValue", options.get("redact_value", g.DEFAULT_REDACTION)))
            return g.redact_columns(df, self.columns, value, form=form, name=self.name, strict=strict)
        if self.action == DIGEST:
            algo = str(options.get("algo", "md5"))
            return g.digest_columns(df, self.columns, algo, form=form, name=self.name, strict=strict)
        if self.action == FILTER:
            return g.filter_rows(df, str(options["clause"]))
        if self.action == SAMPLE:
            seed = options.get("seed")
            fraction = float(options.get("fraction", g.DEFAULT_FRACTION))
            return g.sample_rows(df, fraction, None if seed is None else int(seed))
        if self.action == NOOP:
            return g.keep_all(df)
        return self._apply_custom(df, form)

    def _apply_custom(self, df: DataFrame, form: str) -> DataFrame:
        target = self.custom
        if inspect.isclass(target):
            # A class gets the step's settings and offers one method per form.
            target = target(self.name, list(self.columns), dict(self.options))
        if hasattr(target, "log") and hasattr(target, "change"):
            return target.change(df) if form == g.CHANGE else target.log(df)
        return df.transform(target)


def flag(value: Any) -> bool:
    """Boolean setting, which may be given as text."""
    return value.lower() == "true" if isinstance(value, str) else bool(value)


def import_object(path: str) -> Any:
    """Object at `package.module.Name` or `package.module:Name`."""
    module, separator, name = path.partition(":")
    if not separator:
        module, _, name = path.rpartition(".")
    try:
        return getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError, ValueError) as error:
        raise ValueError(f"cannot load {path!r}: {error}") from error


def load_step(config: Mapping[str, Any]) -> Step:
    """Step from its configuration entry: name, action, columns, options, class."""
    known = {"name", "action", "columns", "options", "class"}
    unknown = set(config) - known
    if unknown:
        raise ValueError(f"unknown keys {sorted(unknown)} in a transformation, use {sorted(known)}")
    for needed in ("name", "action"):
        if needed not in config:
            raise ValueError(f"a transformation needs {needed!r}: {dict(config)}")
    custom = None
    if str(config["action"]).lower() == CUSTOM and "class" in config:
        given = config["class"]
        custom = import_object(given) if isinstance(given, str) else given
    return Step(
        name=config["name"],
        action=str(config["action"]),
        columns=tuple(config.get("columns") or ()),
        options=dict(config.get("options") or {}),
        custom=custom,
    )


def load_steps(configs: Iterable[Mapping[str, Any] | Step] | None) -> list[Step]:
    """Steps in order, neighbouring removals fused."""
    return merge_steps([c if isinstance(c, Step) else load_step(c) for c in configs or ()])


def merge_steps(steps: Sequence[Step]) -> list[Step]:
    """Fuse neighbouring removals into one; every other order is kept.

    Removals further apart stay where they are: a step between them may need the column.
    """
    merged: list[Step] = []
    for step in steps:
        last = merged[-1] if merged else None
        if last and last.action == step.action == REMOVE and last.options == step.options:
            names = tuple(dict.fromkeys(last.columns + step.columns))
            merged[-1] = replace(last, columns=names)
        else:
            merged.append(step)
    return merged


def apply_steps(df: DataFrame, steps: Iterable[Step], form: str = g.LOG) -> DataFrame:
    """Apply the steps one after the other."""
    for step in steps:
        df = step.apply(df, form)
    return df
