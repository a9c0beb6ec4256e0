"""Engine settings, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from tickline.functions.fixed import KINDS, MAX_DEPTH_ITEMS, MAX_QUEUE_ITEMS, MAX_TEXT_BYTES

FROM_OPEN, PARTIAL = "from_open", "partial"


@dataclass(frozen=True)
class EngineConfig:
    """Settings of a run. Times are nanoseconds on the receive clock; None as a wait never ends by itself."""

    trade_date: int = 20260806
    mode: str = FROM_OPEN
    streams: tuple[tuple[int, int, int], ...] = tuple(k.key for k in KINDS)
    owners: int = 1
    maximum_tick_body_bytes: int = 512
    maximum_snapshot_body_bytes: int = 65536
    initial_hold_ns: int = 200_000
    partial_wait_ns: int | None = 500_000
    from_open_wait_ns: int | None = 500_000
    reorder_entries: int = 4096
    maximum_span: int = 4096
    maximum_text_bytes: int = MAX_TEXT_BYTES
    maximum_depth_items: int = MAX_DEPTH_ITEMS
    maximum_queue_items: int = MAX_QUEUE_ITEMS
    #: Channels that a live engine has room for; None for any number.
    maximum_channels: int | None = None

    def __post_init__(self) -> None:
        self.validate()

    @property
    def wait_ns(self) -> int | None:
        return self.from_open_wait_ns if self.mode == FROM_OPEN else self.partial_wait_ns

    def validate(self) -> None:
        """Raises ValueError for settings that no run can have."""
        if not trade_date_valid(self.trade_date):
            raise ValueError(f"trade_date {self.trade_date} is no calendar date from 1992 to 2200")
        if self.mode not in (FROM_OPEN, PARTIAL):
            raise ValueError(f"unknown mode {self.mode}")
        known = {k.key for k in KINDS}
        if not self.streams or not set(self.streams) <= known:
            raise ValueError("streams has no stream or an unknown one")
        if self.owners < 1:
            raise ValueError("owners must be positive")
        if self.maximum_tick_body_bytes < 70 or self.maximum_snapshot_body_bytes < 248:
            raise ValueError("body capacity is too small")
        if self.reorder_entries < 2 or self.reorder_entries & (self.reorder_entries - 1) or self.maximum_span > self.reorder_entries:
            raise ValueError("reorder_entries must be a power of two and at least maximum_span")
        if not 0 < self.maximum_text_bytes <= MAX_TEXT_BYTES or self.maximum_depth_items < 1 or self.maximum_queue_items < 1:
            raise ValueError("decoder limits are invalid")
        if self.maximum_channels is not None and self.maximum_channels < 1:
            raise ValueError("maximum_channels must be positive")
        if self.initial_hold_ns < 0 or any(w is not None and w < 0 for w in (self.partial_wait_ns, self.from_open_wait_ns)):
            raise ValueError("waits must not be negative")


def trade_date_valid(value: int) -> bool:
    """Whether YYYYMMDD is a date of the years 1992 to 2200."""
    try:
        return 1992 <= date(value // 10000, value // 100 % 100, value % 100).year <= 2200
    except ValueError:
        return False
