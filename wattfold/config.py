"""Engine settings: slice widths, alert switches per level, topics, watermark."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from math import gcd, lcm
from typing import Any

MINUTES_PER_DAY = 1440

# The slice widths in minutes that every reading is counted under.
DEFAULT_GAPS = (1, 5, 10, 15, 20, 30, 60, 120)

DEVICE = "device"
HOUSEHOLD = "household"
HOUSE = "house"
LEVELS = (DEVICE, HOUSEHOLD, HOUSE)


def check_gaps(gaps) -> tuple[int, ...]:
    """Sorted distinct gaps; a gap must divide the day, or its last slice would wrap."""
    out = tuple(sorted({int(g) for g in gaps}))
    if not out:
        raise ValueError("at least one slice gap is needed")
    bad = [g for g in out if g <= 0 or MINUTES_PER_DAY % g]
    if bad:
        raise ValueError(f"slice gaps must divide {MINUTES_PER_DAY} minutes: {bad}")
    return out


def base_gap(gaps) -> int:
    """Widest slice every gap is a multiple of (1 minute for the default gaps)."""
    return gcd(*check_gaps(gaps))


def block_gap(gaps) -> int:
    """Narrowest slice that is a multiple of every gap (120 minutes by default)."""
    return lcm(*check_gaps(gaps))


@dataclass(frozen=True)
class AlertConfig:
    """Which baseline comparisons a level runs, and how far off counts as an alert."""

    pct: int = 20
    check_min: bool = False
    check_avg: bool = True
    check_max: bool = True


@dataclass(frozen=True)
class EngineConfig:
    topics: tuple[str, ...] = ("iot-data",)
    gaps: tuple[int, ...] = DEFAULT_GAPS
    flush_seconds: int = 60
    watermark_minutes: int = 600
    # A device not heard of for so long is closed up to its newest reading.
    idle_minutes: int = 2 * MINUTES_PER_DAY
    topic_prefix: str = ""
    publish_alerts: bool = True
    clean_tables: bool = False
    alerts: Mapping[str, AlertConfig] = field(
        default_factory=lambda: {level: AlertConfig() for level in LEVELS}
    )

    def __post_init__(self):
        object.__setattr__(self, "gaps", check_gaps(self.gaps))
        # A forecast is final once its source slice is: the day-old history it reads
        # has to be behind the watermark by then.
        limit = MINUTES_PER_DAY - 3 * max(self.gaps)
        if self.watermark_minutes > max(limit, 0):
            raise ValueError(f"watermark_minutes may not exceed {limit} for gaps {self.gaps}")

    @classmethod
    def from_mapping(cls, conf: Mapping[str, Any]) -> EngineConfig:
        """Build from the flat dotted keys of a configuration file; absent keys keep defaults."""
        # The keys below are those of existing configuration files.
        base = cls()
        alerts = {}
        for level in LEVELS:
            d = AlertConfig()
            at = f"notification.{level}."
            alerts[level] = AlertConfig(
                pct=int(conf.get(at + "logGap", d.pct)),
                check_min=bool(conf.get(at + "checkMin", d.check_min)),
                check_avg=bool(conf.get(at + "checkAvg", d.check_avg)),
                check_max=bool(conf.get(at + "checkMax", d.check_max)),
            )
        return cls(
            topics=tuple(conf.get("spout.topicList", base.topics)),
            gaps=tuple(conf.get("iot analytics.windowList", base.gaps)),
            flush_seconds=int(conf.get("database.updateInterval", base.flush_seconds)),
            topic_prefix=str(conf.get("notification.topicPrefix", base.topic_prefix)),
            publish_alerts=bool(conf.get("notification.publishMQTT", base.publish_alerts)),
            clean_tables=bool(conf.get("database.clean", base.clean_tables)),
            alerts=alerts,
        )

    @classmethod
    def from_yaml(cls, path: str) -> EngineConfig:
        try:
            import yaml
        except ImportError as err:
            raise RuntimeError("reading a YAML configuration needs PyYAML") from err
        with open(path, encoding="utf-8") as fh:
            return cls.from_mapping(yaml.safe_load(fh) or {})


# The switches the shipped configuration turns on (max only, 20 %).
SHIPPED_ALERTS = AlertConfig(pct=20, check_min=False, check_avg=False, check_max=True)
