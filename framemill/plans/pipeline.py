"""Registered table steps, and their composition into one lazy plan."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]
_STEPS: dict[str, Callable[..., Step | None]] = {}


def register_step(name: str) -> Callable:
    """Add a step: options -> (DataFrame -> DataFrame), or None where it would do nothing."""

    def add(fn: Callable[..., Step | None]) -> Callable[..., Step | None]:
        if name in _STEPS:
            raise ValueError(f"step {name} is registered twice")
        _STEPS[name] = fn
        return fn

    return add


def steps() -> list[str]:
    """Names of the registered steps."""
    return sorted(_STEPS)


def plan(config: list[tuple[str, dict]]) -> list[tuple[str, Step]]:
    """The steps of a configuration, those that do nothing left out. Only registered names are accepted."""
    out = []
    for name, options in config:
        if name not in _STEPS:
            raise ValueError(f"unknown step {name}; known are {', '.join(steps())}")
        step = _STEPS[name](**options)
        if step is not None:
            out.append((name, step))
    return out


def describe(config: list[tuple[str, dict]]) -> str:
    """What would run, in order."""
    return " -> ".join(name for name, _ in plan(config)) or "nothing to do"


def run(df: DataFrame, config: list[tuple[str, dict]]) -> DataFrame:
    """All steps composed; Catalyst sees one plan."""
    return reduce(lambda d, s: d.transform(s[1]), plan(config), df)


@register_step("assemble")
def _assemble(column: str, slots: list) -> Step:
    from framemill.operators.layout import assemble

    return lambda df: df.withColumn(column, assemble(slots))


@register_step("standardise")
def _standardise(name: str) -> Step:
    from framemill.functions.standardise import standardise

    return lambda df: standardise(df, name)


@register_step("rename")
def _rename(columns: dict[str, str]) -> Step | None:
    changed = {a: b for a, b in columns.items() if a != b}
    return (lambda df: df.withColumnsRenamed(changed)) if changed else None


@register_step("keep_from")
def _keep_from(first: int) -> Step | None:
    return (lambda df: df.filter(f"frame_index >= {int(first)}")) if first > 0 else None
