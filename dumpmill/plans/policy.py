"""The data-quality policy: YAML to checked dataclasses.

::

    skip_records: {entity: [{field, contains, reason}]}
    filters:      {entity: [{field, remove_matching, reason} | {field, nullify_when: {type: range, below?, above?}, reason}]}
    rules:        {entity: [{name, field, severity, condition: {type: ...}, description?}]}

Conditions: required; range (min, max); regex (pattern, a violation where it matches); length (min,
max); enum (values). Everything is checked on load, before any plan is made.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from dumpmill.functions.patterns import java_pattern

ENTITIES = ("artists", "labels", "masters", "releases")
SEVERITIES = ("error", "warning", "info")


class PolicyError(ValueError):
    pass


@dataclass(frozen=True)
class Skip:
    field: str
    contains: str
    reason: str


@dataclass(frozen=True)
class RemoveMatching:
    field: str
    pattern: str
    reason: str


@dataclass(frozen=True)
class NullifyRange:
    field: str
    below: float | None
    above: float | None
    reason: str


@dataclass(frozen=True)
class Rule:
    name: str
    field: str
    severity: str
    kind: str
    low: float | None = None
    high: float | None = None
    pattern: str | None = None
    values: tuple[str, ...] = ()
    description: str = ""


@dataclass(frozen=True)
class EntityPolicy:
    """What holds for one entity, in file order; empty where the policy has nothing on it."""

    skips: tuple[Skip, ...] = ()
    filters: tuple[RemoveMatching | NullifyRange, ...] = ()
    rules: tuple[Rule, ...] = ()


@dataclass(frozen=True)
class Policy:
    entities: dict[str, EntityPolicy] = field(default_factory=dict)

    def of(self, entity: str) -> EntityPolicy:
        return self.entities.get(entity, EntityPolicy())


def load_policy(path: str, entities: Iterable[str] = ENTITIES) -> Policy:
    """Read a .yaml or .yml file on the driver."""
    import yaml

    own = Path(path).resolve()
    if own.suffix not in (".yaml", ".yml"):
        raise PolicyError(f"not a YAML file: {path}")
    return parse_policy(yaml.safe_load(own.read_text("utf-8")) or {}, entities)


def parse_policy(raw: dict[str, Any], entities: Iterable[str] = ENTITIES) -> Policy:
    known = set(entities)
    if not isinstance(raw, dict) or (odd := set(raw) - {"skip_records", "filters", "rules"}):
        raise PolicyError(f"unknown sections: {sorted(odd) if isinstance(raw, dict) else raw!r}")
    parts: dict[str, dict[str, list]] = {}
    for section, make in (("skip_records", _skip), ("filters", _filter), ("rules", _rule)):
        for entity, items in (raw.get(section) or {}).items():
            if entity not in known:
                raise PolicyError(f"{section}: unknown entity {entity!r}")
            parts.setdefault(entity, {})[section] = [make(x) for x in items or []]
    return Policy({
        e: EntityPolicy(tuple(p.get("skip_records", ())), tuple(p.get("filters", ())), tuple(p.get("rules", ()))) for e, p in parts.items()})


def _need(item: dict, *names: str) -> list[str]:
    missing = [n for n in names if not isinstance(item.get(n), str)]
    if missing:
        raise PolicyError(f"{item!r} lacks {missing}")
    return [item[n] for n in names]


def _number(item: dict, name: str) -> float | None:
    value = item.get(name)
    if value is not None and (isinstance(value, bool) or not isinstance(value, int | float)):
        raise PolicyError(f"{name} of {item!r} is no number")
    return value


def _bounds(item: dict, low: str, high: str) -> tuple[float | None, float | None]:
    a, b = _number(item, low), _number(item, high)
    if a is None and b is None:
        raise PolicyError(f"{item!r} needs {low} or {high}")
    return a, b


def _pattern(text: str, where: str) -> str:
    try:
        java_pattern(text)
    except ValueError as e:
        raise PolicyError(f"{where}: {e}") from e
    return text


def _skip(item: dict) -> Skip:
    return Skip(*_need(item, "field", "contains", "reason"))


def _filter(item: dict) -> RemoveMatching | NullifyRange:
    name, reason = _need(item, "field", "reason")
    if "remove_matching" in item:
        return RemoveMatching(name, _pattern(*_need(item, "remove_matching"), f"filter of {name}"), reason)
    when = item.get("nullify_when")
    if not isinstance(when, dict) or when.get("type") != "range":
        raise PolicyError(f"{item!r} needs remove_matching, or nullify_when of type range")
    return NullifyRange(name, *_bounds(when, "below", "above"), reason)


def _rule(item: dict) -> Rule:
    name, target, severity = _need(item, "name", "field", "severity")
    if severity not in SEVERITIES:
        raise PolicyError(f"{name}: unknown severity {severity!r}")
    condition = item.get("condition")
    kind = condition.get("type") if isinstance(condition, dict) else None
    low = high = pattern = None
    values: tuple[str, ...] = ()
    if kind in ("range", "length"):
        low, high = _number(condition, "min"), _number(condition, "max")
    elif kind == "regex":
        pattern = _pattern(*_need(condition, "pattern"), name)
    elif kind == "enum":
        values = tuple(map(str, condition.get("values") or ()))
    elif kind != "required":
        raise PolicyError(f"{name}: unknown condition {kind!r}")
    return Rule(name, target, severity, kind, low, high, pattern, values, item.get("description") or "")


def lint_policy(policy: Policy) -> list[tuple[str, str]]:
    """(entity, rule) of rules that an earlier filter leaves nothing to find: a range rule whose bounds
    the nullified range covers, or a regex rule with the pattern of a remove_matching on its field."""
    out = []
    for entity, own in policy.entities.items():
        for rule in own.rules:
            for f in own.filters:
                if f.field != rule.field:
                    continue
                same = isinstance(f, RemoveMatching) and rule.kind == "regex" and f.pattern == rule.pattern
                covered = isinstance(f, NullifyRange) and rule.kind == "range" and (
                    rule.low is None or f.below is not None and f.below >= rule.low) and (
                    rule.high is None or f.above is not None and f.above <= rule.high)
                if same or covered:
                    out.append((entity, rule.name))
                    break
    return out
