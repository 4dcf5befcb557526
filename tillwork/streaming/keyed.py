"""Inventory state that ends: keys that stay silent leave the state and the table.

The state of a key is what :func:`tillwork.streaming.jobs.inventory_state` computes for it: of each column
the newest known value by event time. It is kept by ``applyInPandasWithState``, which hands over the
rows and states of many keys in one Arrow batch, and it holds a fixed number of values a key
whatever the number of messages. A batch gives back the keys that changed. When the watermark has
passed a key's last update by ``silence``, the key gives one last row, marked ``is_gone``, and its state is
removed; a key that speaks again starts anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillwork.streaming.jobs import STATE_KEYS, STATE_VALUES, described_state, with_event_time
from tillwork.streaming.store import GONE

_NEVER = -(1 << 62)  # the place in time of a message without a time: before all others
_KINDS = {"int": int, "bigint": int, "double": float, "string": str, "boolean": bool}


def _interval_ms(text: str | None) -> int | None:
    return None if text is None else int(pd.Timedelta(text) / pd.Timedelta(milliseconds=1))


def _merger(kinds: list, silence: int | None):
    """The update function: state is (last update, updates, then value, moment and item of each column)."""
    number = len(kinds)

    def put_timeout(state: GroupState, last: int | None) -> None:
        if silence is not None:
            now = max(state.getCurrentWatermarkMs(), 0)
            state.setTimeoutTimestamp(max((now if last is None else last // 1000) + silence, now + 1))

    def merge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names = [*STATE_KEYS, *STATE_VALUES.values(), "last_micros", "update_count", GONE]
        if state.hasTimedOut:
            last, updates, *held = state.get
            state.remove()
            yield pd.DataFrame([(*key, *held[::3], last, updates, True)], columns=names, dtype=object)
            return
        last, updates, *held = state.get if state.exists else (None, 0, *([None, None, None] * number))
        for frame in frames:
            moments = list(zip(frame["_micros"].tolist(), frame["_item"].tolist()))
            updates += int((frame["_item"] != _NEVER).sum())
            newest = max(m for m, _ in moments)
            last = last if newest == _NEVER else newest if last is None else max(last, newest)
            for c, column in enumerate(STATE_VALUES):
                best = (held[3 * c + 1], held[3 * c + 2]) if held[3 * c + 1] is not None else None
                for value, moment in zip(frame[column].tolist(), moments):
                    if value is not None and value == value and (best is None or moment > best):
                        best, held[3 * c] = moment, kinds[c](value)
                if best is not None:
                    held[3 * c + 1:3 * c + 3] = best
        state.update((last, updates, *held))
        put_timeout(state, last)
        yield pd.DataFrame([(*key, *held[::3], last, updates, False)], columns=names, dtype=object)

    return merge


def inventory_changes(messages: DataFrame, silence: str | None = "30 days", late: str = "1 day") -> DataFrame:
    """A stream of the keys that each batch changed, with their whole state, and ``is_gone``.

    Messages later than ``late`` are dropped, as by every event-time operator. ``silence=None`` keeps all keys.
    """
    types = dict(messages.dtypes)
    timed = with_event_time(messages, "updated_at", late)
    never = F.lit(_NEVER)
    rows = timed.select(
        *STATE_KEYS, *STATE_VALUES, "event_time", F.coalesce(F.unix_micros("event_time"), never).alias("_micros"),
        F.coalesce(F.col("inventory_item_id").cast("long"), never).alias("_item"))
    values = [types[c] for c in STATE_VALUES]
    held = ", ".join(f"v{i} {t}, at{i} long, item{i} long" for i, t in enumerate(values))
    out = ", ".join([*(f"{k} {types[k]}" for k in STATE_KEYS), *(f"{n} {t}" for n, t in zip(STATE_VALUES.values(), values)),
                     "last_micros long", "update_count long", f"{GONE} boolean"])
    merged = rows.groupBy(*STATE_KEYS).applyInPandasWithState(
        _merger([_KINDS[t] for t in values], _interval_ms(silence)), out, f"last long, updates long, {held}", "update",
        GroupStateTimeout.NoTimeout if silence is None else GroupStateTimeout.EventTimeTimeout)
    return described_state(merged.withColumn("last_updated", F.timestamp_micros("last_micros")).drop("last_micros"))
