"""Job parameters, checked once before any plan is built."""

from __future__ import annotations

import math
from dataclasses import dataclass

EVENT_TIME = "event_time"
ARRIVAL = "arrival"

# The defaults of the pipeline being reproduced.
DEFAULT_WINDOW_SECONDS = 10.0
DEFAULT_THRESHOLD = 3.0
DEFAULT_MIN_SAMPLES = 5
DEFAULT_BATCH_ROWS = 50
DEFAULT_FLUSH_SECONDS = 2.0
DEFAULT_TOPIC = "market-data-raw"
DEFAULT_SERVERS = "localhost:9092"
DEFAULT_GROUP = "processing-service"
DEFAULT_SOURCE = "binance"


def _positive(name: str, value: float) -> None:
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        raise ValueError(f"{name} must be a number, got {value!r}")
    if not math.isfinite(value) or value <= 0:
        raise ValueError(f"{name} must be finite and > 0, got {value!r}")


def _at_least(name: str, value: int, low: int) -> None:
    if isinstance(value, bool) or not isinstance(value, int) or value < low:
        raise ValueError(f"{name} must be a whole number >= {low}, got {value!r}")


@dataclass(frozen=True)
class WindowParams:
    """What a trailing window covers.

    The scales are a hint: if all values are whole multiples of 10**-scale, sums count in those units,
    which is fastest. Otherwise each symbol gets a scale of its own. ``rows_per_slice`` only steers
    parallelism: once a symbol has more rows than that, rows are cut into slices that run as separate
    tasks. Results do not depend on it.
    """

    window_seconds: float = DEFAULT_WINDOW_SECONDS
    mode: str = EVENT_TIME
    price_scale: int = 8
    quantity_scale: int = 8
    rows_per_slice: int = 2_000_000

    def __post_init__(self) -> None:
        _positive("window_seconds", self.window_seconds)
        if self.window_us < 1:
            raise ValueError("window_seconds must be at least one microsecond")
        if self.mode not in (EVENT_TIME, ARRIVAL):
            raise ValueError(f"mode must be {EVENT_TIME!r} or {ARRIVAL!r}, got {self.mode!r}")
        for name in ("price_scale", "quantity_scale"):
            _at_least(name, getattr(self, name), 0)
            if getattr(self, name) > 15:
                raise ValueError(f"{name} must be <= 15")
        _at_least("rows_per_slice", self.rows_per_slice, 1)

    @property
    def window_us(self) -> int:
        return round(self.window_seconds * 1_000_000)


@dataclass(frozen=True)
class AnomalyParams:
    threshold: float = DEFAULT_THRESHOLD
    min_samples: int = DEFAULT_MIN_SAMPLES

    def __post_init__(self) -> None:
        _positive("threshold", self.threshold)
        _at_least("min_samples", self.min_samples, 2)


@dataclass(frozen=True)
class FlushParams:
    """Micro-batch policy: at most ``rows`` records, a new batch every ``seconds``."""

    rows: int = DEFAULT_BATCH_ROWS
    seconds: float = DEFAULT_FLUSH_SECONDS

    def __post_init__(self) -> None:
        _at_least("rows", self.rows, 1)
        _positive("seconds", self.seconds)
