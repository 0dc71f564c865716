"""Run-time settings. Every value can be overridden from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from parcelflow.model import FINANCIAL, SHIPMENT, TRACKING


def _env(name: str, default):
    raw = os.environ.get(name)
    return default if raw is None else type(default)(raw)


@dataclass(frozen=True)
class StateThresholds:
    """Silence and dwell limits of the shipment tracker, in seconds."""

    stuck_s: int = field(default_factory=lambda: _env("STUCK_TIMEOUT_S", 20))
    lost_s: int = field(default_factory=lambda: _env("LOST_TIMEOUT_S", 40))
    express_dwell_s: int = field(default_factory=lambda: _env("HUB_DWELL_EXPRESS_S", 14))
    standard_dwell_s: int = field(default_factory=lambda: _env("HUB_DWELL_STANDARD_S", 43))
    tombstone_s: int = field(default_factory=lambda: _env("TOMBSTONE_TTL_S", 60))


@dataclass(frozen=True)
class StreamSettings:
    """Watermarks, windows, triggers and per-trigger intake limits."""

    watermarks: dict = field(
        default_factory=lambda: {
            SHIPMENT: _env("WM_SHIPMENT", "60 seconds"),
            TRACKING: _env("WM_TRACKING", "60 seconds"),
            FINANCIAL: _env("WM_FINANCIAL", "60 seconds"),
        }
    )
    union_watermark: str = field(default_factory=lambda: _env("WM_UNIFIED", "60 seconds"))
    # One watermark per input keeps a lagging topic's rows; "union" follows the fastest.
    watermark_scope: str = "topic"
    window: str = field(default_factory=lambda: _env("KPI_WINDOW_DURATION", "5 minutes"))
    slide: str = field(default_factory=lambda: _env("KPI_WINDOW_SLIDING_DURATION", "1 minute"))
    trigger: str = field(default_factory=lambda: _env("TRIGGER_INTERVAL", "10 seconds"))
    # Drain what is there and stop.
    available_now: bool = False
    max_offsets: dict = field(
        default_factory=lambda: {SHIPMENT: 20_000, TRACKING: 80_000, FINANCIAL: 8_000}
    )
    thresholds: StateThresholds = field(default_factory=StateThresholds)
    # Some hundred open shipments a block; the first start of a checkpoint fixes the number.
    tracker_blocks: int = field(default_factory=lambda: _env("TRACKER_BLOCKS", 4096))

    def trigger_args(self) -> dict:
        return {"availableNow": True} if self.available_now else {"processingTime": self.trigger}
