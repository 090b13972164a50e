"""Rule parameters (STR-8) and typed settings (CHK-4).

A rule is a condition over one reading joined with its device's thresholds,
plus the columns reported in the alert, a duration and a cooldown.  Conditions
are comparisons joined with ``&`` and ``|``; batch turns them into a Column, the
stream into numpy masks, with the same meaning.  Rules are data, so users add
their own, with threshold columns of their own, without touching the detector.
"""

from __future__ import annotations

import operator
import os
from dataclasses import dataclass, replace

MEASURES = ("temperature", "humidity", "light", "co2", "humidity_ratio", "occupancy")
_OPS = {"=": operator.eq, "<>": operator.ne, "<": operator.lt, "<=": operator.le,
        ">": operator.gt, ">=": operator.ge}


class Condition:
    """A boolean over a reading's columns; a comparison with NULL or NaN is false."""

    def __and__(self, other: "Condition") -> "Condition":
        return Join("and", (self, _condition(other)))

    def __or__(self, other: "Condition") -> "Condition":
        return Join("or", (self, _condition(other)))


def _condition(c) -> Condition:
    if not isinstance(c, Condition):
        raise TypeError(f"not a condition: {c!r}; build it from Compare(column, op, column or number), & and |")
    return c


@dataclass(frozen=True)
class Compare(Condition):
    """``left op right``: a column against a column or a number."""
    left: str
    op: str
    right: str | float

    def __post_init__(self):
        if self.op not in _OPS:
            raise ValueError(f"unknown comparison {self.op!r}; known: {', '.join(_OPS)}")
        if not (isinstance(self.left, str) and self.left.isidentifier()):
            raise ValueError(f"not a column name: {self.left!r}")
        if isinstance(self.right, bool) or not (isinstance(self.right, (int, float))
                                                or isinstance(self.right, str) and self.right.isidentifier()):
            raise ValueError(f"neither a column name nor a number: {self.right!r}")

    @property
    def columns(self) -> set[str]:
        return {self.left} | ({self.right} if isinstance(self.right, str) else set())

    def column(self):
        from pyspark.sql import functions as F

        right = F.col(self.right) if isinstance(self.right, str) else F.lit(self.right)
        holds = _OPS[self.op](F.col(self.left), right)
        for c in self.columns:                 # Spark orders NaN above every number; a missing value meets nothing
            holds = holds & ~F.isnan(F.col(c).cast("double"))
        return F.coalesce(holds, F.lit(False))

    def mask(self, cols: dict):
        """The same over numpy float columns, in which NULL is NaN."""
        import numpy as np

        left = cols[self.left]
        right = cols[self.right] if isinstance(self.right, str) else self.right
        return _OPS[self.op](left, right) & ~np.isnan(left) & ~np.isnan(right)


@dataclass(frozen=True)
class Join(Condition):
    """Conditions of which all (``and``) or any (``or``) hold."""
    how: str
    parts: tuple

    @property
    def columns(self) -> set[str]:
        return set().union(*(p.columns for p in self.parts))

    def _fold(self, values):
        values = iter(values)
        out = next(values)
        for v in values:
            out = out & v if self.how == "and" else out | v
        return out

    def column(self):
        return self._fold(p.column() for p in self.parts)

    def mask(self, cols: dict):
        return self._fold(p.mask(cols) for p in self.parts)


@dataclass(frozen=True)
class RuleSpec:
    name: str
    severity: str
    metric: str
    condition: Condition    # checked when the rule is made
    observed: str           # column reported as observed_value
    threshold: str          # column reported as threshold_value
    duration_s: int         # the condition must hold this long (event time)
    cooldown_s: int         # minimum gap between two alerts of this rule

    def __post_init__(self):
        _condition(self.condition)
        for c in (self.observed, self.threshold):
            if not (isinstance(c, str) and c.isidentifier()):
                raise ValueError(f"not a column name: {c!r}")

    @property
    def columns(self) -> set[str]:
        return self.condition.columns | {self.observed, self.threshold}

    @property
    def duration_ms(self) -> int:
        return int(self.duration_s) * 1000

    @property
    def cooldown_ms(self) -> int:
        return int(self.cooldown_s) * 1000


# Fixed values that must equal the reference's: rule names, severities,
# metrics, strict '>' comparisons, and default durations / cooldowns (seconds).
#   NO_OCC_LIGHT   VIOLATION  light        occupancy = 0 and light > light threshold   300 / 600
#   TEMP_WARNING   WARNING    temperature  temperature > warning threshold             1200 / 600
#   TEMP_VIOLATION VIOLATION  temperature  temperature > violation threshold           600 / 600
DEFAULT_RULES: tuple[RuleSpec, ...] = (
    RuleSpec("NO_OCC_LIGHT", "VIOLATION", "light",
             Compare("occupancy", "=", 0) & Compare("light", ">", "no_occupancy_light_threshold"),
             "light", "no_occupancy_light_threshold", 300, 600),
    RuleSpec("TEMP_WARNING", "WARNING", "temperature",
             Compare("temperature", ">", "temperature_warning_threshold"),
             "temperature", "temperature_warning_threshold", 1200, 600),
    RuleSpec("TEMP_VIOLATION", "VIOLATION", "temperature",
             Compare("temperature", ">", "temperature_violation_threshold"),
             "temperature", "temperature_violation_threshold", 600, 600),
)

DEFAULT_THRESHOLDS = ("temperature_warning_threshold", "temperature_violation_threshold",
                      "no_occupancy_light_threshold")


def threshold_columns(rules: tuple[RuleSpec, ...] = DEFAULT_RULES) -> tuple[str, ...]:
    """The config columns that rules need: the default ones, then others by name."""
    used = set().union(*(r.columns for r in rules)) - set(MEASURES)
    return DEFAULT_THRESHOLDS + tuple(sorted(used - set(DEFAULT_THRESHOLDS)))


# Environment variable names for the overrides (seconds).
_ENV_NAMES = {
    "NO_OCC_LIGHT": ("NO_OCC_LIGHT_DURATION_SECONDS", "NO_OCC_LIGHT_COOLDOWN_SECONDS"),
    "TEMP_WARNING": ("TEMP_WARNING_DURATION_SECONDS", "TEMP_WARNING_COOLDOWN_SECONDS"),
    "TEMP_VIOLATION": ("TEMP_VIOLATION_DURATION_SECONDS", "TEMP_VIOLATION_COOLDOWN_SECONDS"),
}


def setting(name: str, default: str | None = None, env: dict | None = None) -> str:
    """Read one setting: blank -> default, missing without default -> error."""
    env = os.environ if env is None else env
    value = env.get(name)
    if value is None or not str(value).strip():
        if default is None:
            raise RuntimeError(f"Missing required setting: {name}")
        return default
    return str(value)


def rules_from_env(env: dict | None = None,
                   rules: tuple[RuleSpec, ...] = DEFAULT_RULES) -> tuple[RuleSpec, ...]:
    """Default rules with durations / cooldowns overridden from the environment."""
    out = []
    for r in rules:
        names = _ENV_NAMES.get(r.name)
        if names is None:
            out.append(r)
            continue
        d = int(setting(names[0], str(r.duration_s), env))
        c = int(setting(names[1], str(r.cooldown_s), env))
        out.append(replace(r, duration_s=d, cooldown_s=c))
    return tuple(out)


def with_timing(rules, duration_s: int | None = None, cooldown_s: int | None = None):
    """Same rules with one duration and/or cooldown for all (contract queries)."""
    return tuple(replace(r,
                         duration_s=r.duration_s if duration_s is None else duration_s,
                         cooldown_s=r.cooldown_s if cooldown_s is None else cooldown_s)
                 for r in rules)


@dataclass(frozen=True)
class StreamSettings:
    """Settings of the streaming alert job (JOB-2)."""
    bootstrap_servers: str
    topic_sensor: str = "iot-sensor-readings"
    topic_config: str = "user-threshold-config"
    topic_alerts: str = "threshold-breached-alerts"
    bronze_root: str = ""
    checkpoint_root: str = ""

    @classmethod
    def from_env(cls, env: dict | None = None) -> "StreamSettings":
        return cls(
            bootstrap_servers=setting("KAFKA_BOOTSTRAP_SERVERS", None, env),
            topic_sensor=setting("TOPIC_SENSOR", "iot-sensor-readings", env),
            topic_config=setting("TOPIC_CONFIG", "user-threshold-config", env),
            topic_alerts=setting("TOPIC_ALERTS", "threshold-breached-alerts", env),
            bronze_root=setting("BRONZE_ROOT", "", env),
            checkpoint_root=setting("CHECKPOINT_ROOT", "", env),
        )
