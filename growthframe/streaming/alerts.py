"""Alert suppression as a stateful stream: what was alerted is remembered per pair, with a timer (T5)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

PAIR = ["website", "event_name"]


def suppress_alerts(candidates: DataFrame, ts: str = "ts", quiet_new: int = 1, quiet_repeat: int = 7, forget_days: int = 180, watermark: str = "3 days") -> DataFrame:
    """Alerts of a stream of daily findings ``(website, event_name, ts, is_new, is_lasting)``, one per pair and day.

    A new finding is an alert unless the pair was alerted less than ``quiet_new`` days ago; a lasting one only if it was alerted
    before, ``quiet_repeat`` days ago or more: the rule of the batch alerts, which read their own history back. Here the history
    is the state of the pair, two dates: the first and the last alert. A pair without a finding for ``forget_days``
    of event time is forgotten by a timer, so the state doesn't grow with pairs long gone. Days of a pair are taken in their
    order within a batch; a finding older than the last alert (late, within the watermark) raises none.

    Adds ``is_new_alert``, ``previous_alert`` and ``first_alert`` (times)."""
    kind = candidates.schema[ts].dataType.simpleString()

    def of(key: tuple, batches: Iterator, state: GroupState) -> Iterator:
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        first, last = state.get if state.exists else (None, None)
        out = []
        rows = pd.concat(list(batches)).sort_values(ts)
        for day, new, lasting in zip(rows[ts], rows["is_new"], rows["is_lasting"]):
            since = None if last is None else (day - last).days
            if (bool(new) and (since is None or since >= quiet_new)) or (bool(lasting) and since is not None and since >= quiet_repeat):
                out.append((*key, day, bool(new), last, first if first is not None else day))
                first, last = first if first is not None else day, day
        if last is not None:
            state.update((first, last))
        elif not state.exists:
            state.update((None, None))
        until = int(rows[ts].max().timestamp() * 1000) + forget_days * 86_400_000
        state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=[*PAIR, ts, "is_new_alert", "previous_alert", "first_alert"])

    result = f"website string, event_name string, {ts} {kind}, is_new_alert boolean, previous_alert {kind}, first_alert {kind}"
    return candidates.withWatermark(ts, watermark).groupBy(*PAIR).applyInPandasWithState(
        of, result, f"first {kind}, last {kind}", "append", GroupStateTimeout.EventTimeTimeout)
