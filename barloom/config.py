"""Fixed values of the domain, and one small group of settings for each component that reads them."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from typing import TypeVar

# Daily price limits by board, the tolerance added to them, the slack of the OHLC rule, the price scale.
PRICE_LIMITS = {"main": 0.10, "star": 0.20, "b_share": 0.10, "other": 0.20}
LIMIT_TOLERANCE = 0.005
OHLC_EPSILON = 1e-6
PRICE_SCALE = 10_000
MAX_SCALED = 2_147_483_646
# The market cap that closes an open band, the least cap that vendors report, the narrowest band, the deepest split.
CAP_CEILING = 5e12
MIN_RESOLVABLE_CAP = 1e6
MIN_BAND_RATIO = 1.01
DEEPEST_BAND = 12
# Rows that one screen returns at most, and the prefixes that are probed.
SCREEN_ROWS = 1000
CODE_PREFIXES = ("600", "601", "603", "605", "688", "689", "900")


@dataclass(frozen=True)
class Retry:
    """How a connector repeats and paces its calls; the defaults are fixed values."""

    attempts: int = 5
    base: float = 1.5
    longest: float = 60.0
    per_minute: int = 90


@dataclass(frozen=True)
class Horizon:
    """From when history is kept, and how many calendar days an update reads again; the defaults are fixed values."""

    first_day: dt.date = dt.date(2010, 1, 1)
    overlap_days: int = 10


@dataclass(frozen=True)
class Capacity:
    """What a store may hold, and the share of it at which writing stops; the defaults are fixed values."""

    most_bytes: int = 512 << 20
    halt_share: float = 0.90

    @property
    def halt_bytes(self) -> int:
        return int(self.most_bytes * self.halt_share)


Group = TypeVar("Group", Retry, Horizon, Capacity)


def from_environment(group: Group, env: Mapping[str, str] | None = None) -> Group:
    """The group with what variables like ``BARLOOM_RETRY_ATTEMPTS`` state; a value of another type raises."""
    env, found = os.environ if env is None else env, {}
    for f in fields(group):
        if (text := env.get(f"BARLOOM_{type(group).__name__}_{f.name}".upper())) is not None:
            now = getattr(group, f.name)
            found[f.name] = dt.date.fromisoformat(text) if isinstance(now, dt.date) else type(now)(text)
    return replace(group, **found)
