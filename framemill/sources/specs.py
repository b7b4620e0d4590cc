"""Declarations of datasets, strictly read: a key that isn't known is an error, not something passed over."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession

from framemill.sources.files import filesystem


class SpecError(ValueError):
    """A declaration that can't be taken as it is."""


@dataclass(frozen=True)
class Block:
    """A body part's stretch of a vector; without a source it must be constant."""

    name: str
    width: int
    source: str | None = None
    first: int = 0
    evidence: str = "unknown"


@dataclass(frozen=True)
class Spec:
    """A dataset: rate, layout order, blocks of state and action (the action's are the state's if left out), cameras."""

    dataset: str
    fps: float
    order: list[str] = field(default_factory=list)
    state: list[Block] = field(default_factory=list)
    action: list[Block] | None = None
    cameras: list[str] = field(default_factory=list)
    episodes: int | None = None


# What a block's values may rest on.
EVIDENCE = ("measured", "declared", "inferred", "constant", "unknown")


def _load(text: str) -> dict:
    try:
        import yaml

        raw = yaml.safe_load(text)
    except ImportError:
        raw = json.loads(text)
    if not isinstance(raw, dict):
        raise SpecError("a declaration is a mapping")
    return raw


def _checked(raw: dict, kind: type, where: str) -> dict:
    known = {f.name for f in fields(kind)}
    strange = sorted(set(raw) - known)
    if strange:
        raise SpecError(f"{where}: unknown {', '.join(strange)}; known are {', '.join(sorted(known))}")
    return raw


def parse_spec(text: str) -> Spec:
    """A declaration in YAML (JSON where no YAML library is installed)."""
    raw = _checked(_load(text), Spec, "dataset")
    made = dict(raw)
    for side in ("state", "action"):
        if raw.get(side) is not None:
            blocks = [Block(**_checked(b, Block, f"{side} block")) for b in raw[side]]
            for b in blocks:
                if b.evidence not in EVIDENCE:
                    raise SpecError(f"{b.name}: unknown evidence {b.evidence}")
            made[side] = blocks
    try:
        spec = Spec(**made)
    except TypeError as e:
        raise SpecError(str(e)) from e
    names = [b.name for b in spec.state]
    if spec.order and sorted(spec.order) != sorted(names):
        raise SpecError(f"layout and blocks differ in {', '.join(sorted(set(spec.order) ^ set(names)))}")
    return spec


def unbuildable(spec: Spec) -> list[str]:
    """Blocks that have neither a source nor constant evidence."""
    return [b.name for b in [*spec.state, *(spec.action or [])] if b.source is None and b.evidence != "constant"]


def block_table(spark: SparkSession, specs: list[Spec]) -> DataFrame:
    """``dataset, side, block, width, source, first, evidence`` of declarations; the action inherits the state's blocks."""
    rows = [(s.dataset, side, b.name, b.width, b.source, b.first, b.evidence) for s in specs for side, blocks in (("state", s.state), ("action", s.action if s.action is not None else s.state)) for b in blocks]
    return spark.createDataFrame(rows, "dataset string, side string, block string, width bigint, source string, first bigint, evidence string")


#: Keys of an environment, of its runtime and batch sections, and of a profile, which an environment may not have.
ENVIRONMENT = ("name", "source", "work", "dest", "state", "runtime", "builders", "batch")
RUNTIME = ("workers", "threads", "executor", "memory_gb", "keep_source", "timeout_s")
BATCH = ("max_datasets", "target_episodes")
PROFILE = ("codec", "crf", "preset", "gop", "pix_fmt", "height", "width", "fps", "resize")


def read_text(path: str) -> str:
    """A document's text; one that isn't there is an error that names it."""
    system, at = filesystem(path)
    try:
        with system.open_input_stream(at) as f:
            return f.read().decode()
    except FileNotFoundError as e:
        raise SpecError(f"there is no {path}") from e


def _only(raw: dict, known: tuple[str, ...], where: str) -> dict:
    strange = sorted(set(raw) - set(known))
    if strange:
        raise SpecError(f"{where}: unknown {', '.join(strange)}; known are {', '.join(sorted(known))}")
    return raw


def _section(raw: dict, name: str) -> dict:
    found = raw.get(name) or {}
    if not isinstance(found, dict):
        raise SpecError(f"{name} is a mapping")
    return found


def parse_layout(text: str) -> tuple[str, ...]:
    """The order of blocks that a layout declares: a list of names, not empty, each once."""
    order = _only(_load(text), ("order", "description"), "layout").get("order")
    if not isinstance(order, list) or not order or not all(isinstance(o, str) for o in order):
        raise SpecError("order is a list of block names")
    if len(set(order)) != len(order):
        raise SpecError("order repeats a block name")
    return tuple(order)


def parse_environment(text: str) -> dict:
    """Where a build runs and how fast; what decides what is built belongs to a profile and is refused here."""
    raw = dict(_only(_load(text), ENVIRONMENT, "environment"))
    misplaced = sorted(set(_section(raw, "runtime")) & set(PROFILE))
    if misplaced:
        raise SpecError(f"runtime: {', '.join(misplaced)} decides what is built and belongs to a profile")
    _only(_section(raw, "runtime"), RUNTIME, "runtime")
    _only(_section(raw, "batch"), BATCH, "batch")
    if not all(isinstance(v, dict) for v in _section(raw, "builders").values()):
        raise SpecError("builders maps a builder's name to its settings")
    return raw


def parse_profile(text: str) -> dict:
    """How pictures are encoded; an explicit null is a value."""
    return dict(_only(_load(text), PROFILE, "profile"))


def parse_pipeline(text: str) -> dict:
    """A pipeline's declaration: name, source and dest, which must differ, steps and runtime."""
    raw = dict(_only(_load(text), ("name", "profile", "dataset", "source", "dest", "steps", "runtime"), "pipeline"))
    if not isinstance(raw.get("name"), str) or not raw["name"].strip():
        raise SpecError("name is a text that isn't empty")
    for side in ("source", "dest"):
        if not isinstance(raw.get(side), dict) or not raw[side].get("path"):
            raise SpecError(f"{side} needs a path")
    if raw["source"]["path"] == raw["dest"]["path"]:
        raise SpecError("source and dest are the same; input is never changed in place")
    _only(_section(raw, "runtime"), RUNTIME, "runtime")
    return raw
