"""Notification state as a stream.

Batch form: ``operators.delivery.delivery_state`` (a max_by group-by).  On a
stream the same state is kept per notification with
``applyInPandasWithState``: each micro-batch folds the new attempts of a key
into (attempts, newest attempt, failed channels) and emits the current state
in update mode.  An event-time timeout removes a key a day after its last
attempt, so the state store stays bounded.
"""

from __future__ import annotations

import json
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marquee.operators.delivery import ACK_TIMEOUT_S, DEFAULT_CHAIN, FAILOVER_S

OUT_SCHEMA = ("notif_id string, attempts long, last_status string, last_channel string, "
              "failed_channels string, state string, next_channel string")
STATE_SCHEMA = ("attempts long, last_ts timestamp, last_id long, last_status string, last_channel string, "
                "failed string, preferred string")


def _next(preferred, failed: set, chain=DEFAULT_CHAIN):
    for c in ([preferred] if preferred else []) + list(chain):
        if c not in failed:
            return c
    return None


def _update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    (notif_id,) = key
    if state.hasTimedOut:
        state.remove()
        return
    if state.exists:
        attempts, last_ts, last_id, last_status, last_channel, failed, pref = state.get
        failed_set = set(failed.split(",")) if failed else set()
    else:
        attempts, last_ts, last_id, last_status, last_channel, pref = 0, None, None, None, None, None
        failed_set = set()
    for pdf in batches:
        attempts += len(pdf)
        failed_set |= set(pdf.loc[pdf["status"] == "CHANNEL_FAILED", "channel"])
        if pref is None and "preferred_channel" in pdf and pdf["preferred_channel"].notna().any():
            pref = pdf["preferred_channel"].dropna().iloc[0]
        top = pdf.sort_values(["ts", "attempt_id"]).iloc[-1]
        if last_ts is None or (top["ts"], top["attempt_id"]) > (pd.Timestamp(last_ts), last_id):
            last_ts, last_id = top["ts"], int(top["attempt_id"])
            last_status, last_channel = top["status"], top["channel"]
    failed_s = ",".join(sorted(failed_set))
    state.update((attempts, pd.Timestamp(last_ts).to_pydatetime(), last_id, last_status, last_channel,
                  failed_s, pref))
    state.setTimeoutTimestamp(int(pd.Timestamp(last_ts).timestamp() * 1000) + 86_400_000)
    nxt = _next(pref, failed_set)
    st = "DELIVERED" if last_status == "DELIVERED" else ("FAILOVER" if nxt else "EXHAUSTED")
    yield pd.DataFrame([{"notif_id": notif_id, "attempts": attempts, "last_status": last_status,
                         "last_channel": last_channel, "failed_channels": failed_s, "state": st,
                         "next_channel": None if st == "DELIVERED" else nxt}])


def delivery_state_stream(attempts: DataFrame, watermark: str = "1 day") -> DataFrame:
    """T7 on a stream of attempts (``ts`` must be TIMESTAMP for the
    watermark).  ``preferred_channel`` may be joined in beforehand."""
    a = attempts if "preferred_channel" in attempts.columns else attempts.withColumn(
        "preferred_channel", F.lit(None).cast("string"))
    return (a.withWatermark("ts", watermark).groupBy("notif_id")
            .applyInPandasWithState(_update, OUT_SCHEMA, STATE_SCHEMA, "update",
                                    GroupStateTimeout.EventTimeTimeout))


MACHINE_SCHEMA = ("notif_id string, steps long, state string, delivered_by string, failed_channels string, next_channel string, "
                  "as_of_ms long")
#: Seconds after its last step that a notification is forgotten, so the state store stays bounded.
FORGET_S = 7 * 86_400


class Notification:
    """Steps of one notification: per channel the last one, and the newest acknowledgement."""

    def __init__(self, kept: str | None, timeout_ms: int, failover_ms: int):
        d = json.loads(kept) if kept else {}
        self.steps, self.last_ms, self.preferred = d.get("steps", 0), d.get("last_ms", 0), d.get("preferred")
        self.channels: dict[str, list] = d.get("channels", {})
        self.ok: list | None = d.get("ok")
        self.timeout_ms, self.failover_ms = timeout_ms, failover_ms

    def kept(self) -> str:
        return json.dumps({k: getattr(self, k) for k in ("steps", "last_ms", "preferred", "channels", "ok")})

    def add(self, ms: int, us: int, step_id: int, step: str, channel: str | None, preferred: str | None) -> None:
        self.steps += 1
        self.last_ms = max(self.last_ms, ms)
        self.preferred = self.preferred or preferred
        if step == "DELIVERED" and (self.ok is None or [us, step_id] > self.ok[:2]):
            self.ok = [us, step_id, channel]
        if channel is not None and (channel not in self.channels or [us, step_id] > self.channels[channel][:2]):
            self.channels[channel] = [us, step_id, step]

    def at(self, now_ms: int) -> tuple[dict, int | None]:
        """The state at ``now_ms`` and when it will change by itself (None: never)."""
        failed, overdue, flying, failed_ms = set(), [], False, None
        for channel, (us, _, step) in self.channels.items():
            due = us // 1000 + (self.timeout_ms if step == "DISPATCHED" else 0)
            if self.ok and step == "DISPATCHED":
                continue  # no longer waited for
            if step == "DISPATCHED" and due > now_ms:
                flying = True
                overdue.append(due)
            elif step in ("DISPATCHED", "CHANNEL_FAILED"):
                failed.add(channel)
                failed_ms = max(failed_ms or 0, due)
        nxt, change = _next(self.preferred, failed), None
        if self.ok:
            state = "DELIVERED"
        elif flying:
            state, change = "DISPATCHING", min(overdue)
        elif failed_ms is None:
            state = "PENDING"
        elif failed_ms + self.failover_ms > now_ms:
            state, change = "CHANNEL_FAILED", failed_ms + self.failover_ms
        else:
            state = "FAILOVER" if nxt else "EXHAUSTED"
        return {"steps": self.steps, "state": state, "delivered_by": self.ok[2] if self.ok else None, "failed_channels": ",".join(sorted(failed)),
                "next_channel": nxt if state in ("PENDING", "CHANNEL_FAILED", "FAILOVER") else None, "as_of_ms": now_ms}, change


def delivery_machine_stream(steps: DataFrame, watermark: str = "1 hour", ack_timeout_s: int = ACK_TIMEOUT_S, failover_s: int = FAILOVER_S,
                            forget_s: int = FORGET_S) -> DataFrame:
    """T7 on a stream of steps, all six states (batch form: ``operators.delivery.delivery_machine``).

    A key holds its channels' last steps.  Event-time timers fire when the
    watermark passes an unanswered dispatch's time limit or the end of the
    failover delay, and the notification moves on without a new step.  The clock of a row is the
    watermark, or its own latest step if that is later; ``as_of_ms`` reports
    it.  ``preferred_channel`` may be joined in beforehand; ``ts`` is a TIMESTAMP."""
    def update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = Notification(state.get[0] if state.exists else None, ack_timeout_s * 1000, failover_s * 1000)
        for pdf in batches:
            us = pdf["us"].to_numpy()
            for u, i, step, channel, preferred in zip(us, pdf["step_id"], pdf["step"], pdf["channel"], pdf["preferred_channel"]):
                n.add(int(u) // 1000, int(u), int(i), step, channel if isinstance(channel, str) else None, preferred if isinstance(preferred, str) else None)
        mark = state.getCurrentWatermarkMs()
        if state.hasTimedOut and mark >= n.last_ms + forget_s * 1000:
            state.remove()
            return
        now = max(mark, n.last_ms)
        row, change = n.at(now)
        state.update((n.kept(),))
        ends = n.last_ms + forget_s * 1000
        state.setTimeoutTimestamp(max(min(change, ends) if change else ends, mark + 1))
        yield pd.DataFrame([{"notif_id": key[0], **row}])

    s = steps if "preferred_channel" in steps.columns else steps.withColumn("preferred_channel", F.lit(None).cast("string"))
    return (s.withWatermark("ts", watermark).withColumn("us", F.unix_micros("ts")).groupBy("notif_id")
            .applyInPandasWithState(update, MACHINE_SCHEMA, "kept string", "update", GroupStateTimeout.EventTimeTimeout))


def tier_sinks(stream: DataFrame, root: str, checkpoint_root: str, trigger: dict | None = None):
    """One file sink per tier (the Kafka form would set a ``topic``
    column instead)."""
    qs = []
    for tier in ("transactional", "service", "marketing"):
        qs.append(stream.where(F.col("tier") == tier).writeStream.format("parquet")
                  .option("path", f"{root}/{tier}").option("checkpointLocation", f"{checkpoint_root}/{tier}")
                  .trigger(**(trigger or {"availableNow": True})).start())
    return qs


def start_dead_letter_sink(states: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """K8: exhausted notifications from the state stream go to their own
    table.  Each micro-batch writes under ``batch_id=<id>`` with overwrite,
    so a replayed batch replaces its own rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.where(F.col("state") == "EXHAUSTED").write.mode("overwrite")
         .parquet(f"{path}/batch_id={batch_id}"))
    return (states.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
