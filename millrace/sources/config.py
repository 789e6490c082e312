"""Configuration: read, checked whole, never defaulted."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

#: The keys, what the acquisition side calls them (if it is told), and what each must be.
FIELDS = """
max_scroll_cycles maxCycles count
pg_down_delay delayMs range
scroll_fraction scrollFrac share
settle_ms settleMs count
load_wait_ms loadWaitMs count
stuck_limit stuckLimit count
max_minutes maxMinutes count
max_posts maxPosts count
max_age_days - count
overlap_hours - count
stop_streak stopStreak count
sort_wait_ms sortWaitMs count
hidden_grace_ms hiddenGraceMs count
"""


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Field:
    """A parameter: count (a whole number, 1 or more), range (two numbers that don't fall) or share (a range within 1)."""

    name: str
    short: str | None
    kind: str

    def faults(self, given: dict) -> Iterator[str]:
        """What is wrong with this field, in words."""
        if self.name not in given:
            yield f"{self.name} is missing"
            return
        ends = given[self.name] if self.kind != "count" else [given[self.name]]
        if not isinstance(ends, list) or len(ends) != (1 if self.kind == "count" else 2):
            yield f"{self.name} must be a pair of numbers"
        elif not all(map(_is_number, ends)):
            yield f"{self.name} must be of numbers"
        elif self.kind == "count":
            if int(ends[0]) < 1:
                yield f"{self.name} must be at least 1"
        elif ends != sorted(ends):
            yield f"{self.name} falls from {ends[0]} to {ends[1]}"
        elif self.kind == "share" and ends[1] > 1:
            yield f"{self.name} must stay within 1"

    def value(self, given: dict) -> int | list[int | float]:
        if self.kind == "count":
            return int(given[self.name])
        return [int(x) if x == int(x) else x for x in given[self.name]]


def _is_number(x: object) -> bool:
    return isinstance(x, int | float) and not isinstance(x, bool) and math.isfinite(x)


TABLE = [Field(name, None if short == "-" else short, kind) for name, short, kind in map(str.split, FIELDS.split("\n")[1:-1])]
INTEGERS = [f.name for f in TABLE if f.kind == "count"]


@dataclass(frozen=True)
class AcquisitionConfig:
    values: dict[str, int | list[int | float]]

    @staticmethod
    def of(given: object) -> AcquisitionConfig:
        """Checked whole: an error names every fault, not the first."""
        if not isinstance(given, dict):
            raise ConfigError("no object of parameters")
        if faults := [fault for field in TABLE for fault in field.faults(given)]:
            raise ConfigError("; ".join(faults))
        return AcquisitionConfig({field.name: field.value(given) for field in TABLE})

    @staticmethod
    def read(path: str, section: str = "scraper_params") -> AcquisitionConfig:
        return AcquisitionConfig.of(read_json(path).get(section))

    def line(self, stop_before_ms: int) -> str:
        """One line of compact JSON under the acquisition side's names."""
        told = {f.short: self.values[f.name] for f in TABLE if f.short}
        return json.dumps(told | {"stopBeforeMs": stop_before_ms}, separators=(",", ":"))


def read_json(path: str) -> dict:
    try:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
    except FileNotFoundError:
        raise ConfigError(f"{path} is missing") from None
    except json.JSONDecodeError as e:
        raise ConfigError(f"{path} is not JSON: line {e.lineno}") from None
    if not isinstance(found, dict):
        raise ConfigError(f"{path} must hold an object")
    return found


def sources(registry: dict) -> list[tuple[str, str, list[str]]]:
    """source, access mode and group urls of a registry of sources."""
    out: list[tuple[str, str, list[str]]] = []
    for name, mode in registry.get("sources", {}).items():
        if isinstance(mode, dict):
            out += [(name, access, list(options.get("group_urls", []))) for access, options in mode.items()]
        else:
            out.append((name, mode, []))
    return out
