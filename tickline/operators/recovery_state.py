"""Sequence recovery of one channel, as a state machine.

The machine puts a channel's records into native order. Records ahead of the
frontier wait in a table of bounded size; a wait that lasts too long, or a table
that is too small, makes a gap. Where a deadline and an arrival coincide the
deadline comes first, but for discovery: a record that arrives after the hold is
taken in before discovery ends, and so can lower the origin.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

from tickline.plans.config import FROM_OPEN, EngineConfig


class Record(NamedTuple):
    ingress: int
    sequence: int
    payload: str
    matched: bool


class Event(NamedTuple):
    """kind: tick, unmatched, gap, late, fault or dropped. Fields that a kind has none of are None."""

    kind: str
    ingress: int | None = None
    sequence: int | None = None
    history: bool | None = None
    epoch: int | None = None
    gap_first: int | None = None
    gap_last: int | None = None
    next_sequence: int | None = None
    missing: int | None = None
    detected_ns: int | None = None
    reason: str | None = None


@dataclass
class Channel:
    mode: str
    wait: int | None
    hold: int
    entries: int
    span: int
    expected: int = 1
    discovering: bool = False
    frozen: bool = False
    complete: bool = True
    epoch: int = 0
    missing: int = 0
    gap: tuple[int, int] | None = None
    since: int | None = None
    seen: int | None = None
    pending: dict[int, Record] = field(default_factory=dict)
    slots: dict[int, int] = field(default_factory=dict)
    heap: list[int] = field(default_factory=list)

    @classmethod
    def start(cls, config: EngineConfig) -> Channel:
        opened = config.mode == FROM_OPEN
        return cls(config.mode, config.wait_ns, config.initial_hold_ns, config.reorder_entries, config.maximum_span, expected=1 if opened else 0, discovering=not opened, complete=opened)

    def deadline(self) -> int | None:
        """When the machine acts without an arrival."""
        if self.frozen or not self.pending:
            return None
        if self.discovering:
            return None if self.seen is None else self.seen + self.hold
        return None if self.since is None or self.wait is None else self.since + self.wait

    def advance(self, now: int) -> Iterator[Event]:
        """Fires every deadline up to now, each at its own time."""
        while (due := self.deadline()) is not None and due <= now:
            yield from self._open(due) if self.discovering else self._skip(due)

    def arrive(self, r: Record, now: int) -> Iterator[Event]:
        if self.discovering and not self.frozen:
            yield from self._discover(r, now)
            return
        yield from self.advance(now)
        if self.frozen:
            yield Event("dropped", r.ingress, r.sequence)
            return
        yield from self._active(r, now)

    def _discover(self, r: Record, now: int) -> Iterator[Event]:
        """A record before the origin is known. A repeat does not end discovery."""
        put = self._put(r)
        if put == "same":
            yield Event("dropped", r.ingress, r.sequence)
        elif put == "conflict":
            yield self._late(r, "pending_canonical_conflict")
        elif put == "full":
            yield from self._open(now)
            yield from self._active(r, now)
        else:
            if self.seen is None:
                self.seen = now
            if now - self.seen >= self.hold:
                yield from self._open(now)

    def fail(self, sequence: int, now: int) -> Iterator[Event]:
        """A record of this channel could not be decoded."""
        yield from self.advance(now)
        if self.mode == FROM_OPEN and not self.frozen:
            yield self._freeze("decode_failure", sequence, now)

    def flush(self, now: int) -> Iterator[Event]:
        """No more records will arrive."""
        if self.frozen:
            return
        if self.discovering:
            yield from self._open(now)
        while self.pending:
            yield from self._skip(now)

    def _put(self, r: Record) -> str:
        slot = r.sequence % self.entries
        held = self.slots.get(slot)
        if held is None:
            self.slots[slot] = r.sequence
            self.pending[r.sequence] = r
            heapq.heappush(self.heap, r.sequence)
            return "new"
        if held != r.sequence:
            return "full"
        return "same" if self.pending[held].payload == r.payload else "conflict"

    def _least(self) -> int:
        """The least sequence that waits; taken ones leave the heap here."""
        while self.heap[0] not in self.pending:
            heapq.heappop(self.heap)
        return self.heap[0]

    def _take(self, sequence: int) -> Record:
        del self.slots[sequence % self.entries]
        return self.pending.pop(sequence)

    def _emit(self, r: Record) -> Event:
        if not r.matched:
            return Event("unmatched", r.ingress, r.sequence, self.complete)
        gap, self.gap = self.gap, None
        if gap is None:
            return Event("tick", r.ingress, r.sequence, self.complete, 0)
        return Event("tick", r.ingress, r.sequence, self.complete, self.epoch, *gap)

    def _drain(self, now: int) -> Iterator[Event]:
        while self.expected in self.pending:
            yield self._emit(self._take(self.expected))
            self.expected += 1
        self.since = now if self.pending else None

    def _open(self, now: int) -> Iterator[Event]:
        self.discovering = False
        if self.pending:
            self.expected = self._least()
            yield from self._drain(now)

    def _missing(self, last: int, now: int) -> Iterator[Event]:
        """The frontier passes everything up to `last`."""
        if last >= self.expected:
            self.complete = False
            self.epoch += 1
            self.missing += last + 1 - self.expected
            self.gap = (self.expected, last)
            yield Event("gap", None, None, False, self.epoch, self.expected, last, last + 1, self.missing, now)
        self.expected = last + 1

    def _skip(self, now: int) -> Iterator[Event]:
        yield from self._missing(self._least() - 1, now)
        yield from self._drain(now)

    def _late(self, r: Record, reason: str) -> Event:
        return Event("late", r.ingress, r.sequence, False, self.epoch, next_sequence=self.expected, reason=reason)

    def _freeze(self, reason: str, sequence: int, now: int) -> Event:
        self.frozen = True
        return Event("fault", None, sequence, next_sequence=self.expected, detected_ns=now, reason=reason)

    def _active(self, r: Record, now: int) -> Iterator[Event]:
        while True:
            if r.sequence < self.expected:
                yield self._late(r, "behind_committed_frontier")
                return
            if r.sequence == self.expected:
                yield self._emit(r)
                self.expected += 1
                yield from self._drain(now)
                return
            far = r.sequence - self.expected > self.span
            put = self._put(r)
            if put == "same":
                yield Event("dropped", r.ingress, r.sequence)
                return
            if put == "conflict":
                yield self._freeze("canonical_conflict", r.sequence, now) if self.mode == FROM_OPEN else self._late(r, "pending_canonical_conflict")
                return
            if put == "full":
                if r.sequence < self._least():
                    yield from self._missing(r.sequence - 1, now)
                else:
                    yield from self._skip(now)
                continue
            if far:
                yield from self._skip(now)
                return
            if self.since is None:
                self.since = now
            if self.wait == 0:
                yield from self._skip(now)
            return
