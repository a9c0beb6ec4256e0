"""Sequence recovery of a stream: the state machine, one instance for each channel, kept by the engine between batches."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickline.operators.recovery import CHANNEL, EVENT_DDL, EVENT_NAMES, INPUT, event_row
from tickline.operators.recovery_state import Channel, Record
from tickline.plans.config import EngineConfig

#: A record of this payload ends its channel's stream.
FLUSH = "\x00flush"
STATE_DDL = "machine binary, now bigint"


def _table(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=EVENT_NAMES).astype({n: "Int64" for n in EVENT_NAMES if n not in ("market", "output_kind", "history_complete", "reason")} | {"history_complete": "boolean"})


def recover_stream(records: DataFrame, config: EngineConfig) -> DataFrame:
    """Events (EVENT_DDL) of a stream of records, in append mode.

    Within a batch a channel's records are taken in order of ingress_sequence;
    batches follow each other in the order of the source. Waits run on the
    records' receive clock: an arrival first fires the deadlines up to it. For a
    channel on which nothing arrives any more, a processing-time timer of a
    millisecond and more stands in. A record with payload FLUSH empties its
    channel at the end of the stream.
    """

    def step(key: tuple, tables: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        market, number = key
        channel, now = (pickle.loads(bytes(state.get[0])), state.get[1]) if state.exists else (Channel.start(config), 0)
        rows = []
        if state.hasTimedOut:
            due = channel.deadline()
            if due is not None:
                rows += [event_row(market, number, e) for e in channel.advance(max(now, due))]
        else:
            for r in pd.concat(list(tables)).sort_values("ingress_sequence", kind="stable").itertuples(index=False):
                now = int(r.receive_monotonic_ns)
                if r.payload == FLUSH:
                    events = channel.flush(now)
                elif r.decode_error is not None and r.decode_error == r.decode_error:
                    events = channel.fail(int(r.native_sequence), now)
                else:
                    events = channel.arrive(Record(int(r.ingress_sequence), int(r.native_sequence), r.payload, bool(r.catalog_match)), now)
                rows += [event_row(market, number, e) for e in events]
        state.update((pickle.dumps(channel), int(now)))
        due = channel.deadline()
        if due is not None:
            state.setTimeoutDuration(max(1, (due - now) // 1_000_000 + 1))
        if rows:
            yield _table(rows)

    return records.select(*INPUT).groupBy(*CHANNEL).applyInPandasWithState(step, EVENT_DDL, STATE_DDL, "append", GroupStateTimeout.ProcessingTimeTimeout)
