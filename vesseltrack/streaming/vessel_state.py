"""Keyed state of the streaming detectors (``watch``).

This module imports nothing of the package: the process that prepares a stateful
operator on the driver does not see archives added to the session, so ``watch``
sends these classes by value.
"""

from __future__ import annotations

import pickle

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor

PING = ["ts", "lat", "lon", "name"]
OUTPUT = ("vessel string, kind string, change int, slot bigint, ts bigint, lat double, lon double, name string, "
          "prev_ts bigint, prev_lat double, prev_lon double, prev_name string, at timestamp")
COLUMNS = [f.split()[0] for f in OUTPUT.split(", ")]
STEP, EDGE, GAP_OPEN = "step", "edge", "gap_open"


def _row(vessel, kind, change, slot, ping, prev, at):
    """Two pings (ts, lat, lon, name); of an edge the last and the first."""
    return (vessel, kind, change, slot, *(ping or (None,) * 4), *(prev or (None,) * 4), at)


def _frame(rows) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=COLUMNS)
    out["at"] = pd.to_datetime(out["at"], unit="us")
    return out.astype({"slot": "Int64", "ts": "Int64", "prev_ts": "Int64", "change": "Int32"})


def _plain(column: pd.Series) -> list:
    """Values of a pandas column; missing ones are None."""
    return [None if v is None or v != v else v for v in column.tolist()]


def _comparable(values) -> tuple:
    """A copy's columns for comparison: null is least."""
    return tuple((0,) if v is None else (1, v) for v in values)


def steps_between(pings: list[tuple]) -> set[tuple]:
    """(ping, predecessor) of consecutive pings in time order."""
    return set(zip(pings[1:], pings[:-1]))


class SlotSteps(StatefulProcessor):
    """Pings of some vessels in one slot; key (shard of vessels, slot)."""

    def __init__(self, slot_us: int, order_columns: int):
        self.slot_us, self.order_columns = slot_us, order_columns

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("pings", "pings binary")

    def handleInputRows(self, key, rows, timerValues):
        slot, known = key[1], self.state.exists()
        vessels = pickle.loads(self.state.get()[0]) if known else {}  # vessel to ts to (copy, (lat, lon, name) or None)
        before, newest = {}, {}
        for frame in rows:
            copies = zip(*(_plain(frame[f"c{i}"]) for i in range(self.order_columns)))
            for vessel, ts, valid, *place, copy in zip(*(frame[c].tolist() for c in ("vessel", "ts", "valid")),
                                                       *(_plain(frame[c]) for c in PING[1:]), copies):
                pings = vessels.setdefault(vessel, {})
                if vessel not in before:
                    before[vessel], newest[vessel] = self._valid(pings), 0
                newest[vessel] = max(newest[vessel], ts)
                if ts not in pings or _comparable(copy) > _comparable(pings[ts][0]):
                    pings[ts] = copy, tuple(place) if valid else None
        self.state.update((pickle.dumps(vessels),))
        if not known:
            self.handle.registerTimer((slot + 1) * self.slot_us // 1000)
        out = []
        for vessel, was in before.items():
            now, at = self._valid(vessels[vessel]), newest[vessel]
            old, new = steps_between(was), steps_between(now)
            out += [_row(vessel, STEP, -1, slot, *s, at) for s in sorted(old - new, key=_by_time)]
            out += [_row(vessel, STEP, 1, slot, *s, at) for s in sorted(new - old, key=_by_time)]
            if [*was[:1], *was[-1:]] != [*now[:1], *now[-1:]]:
                out.append(_row(vessel, EDGE, 1, slot, *(now[-1:] or [None]), *(now[:1] or [None]), at))
        if out:
            yield _frame(out)

    @staticmethod
    def _valid(pings) -> list[tuple]:
        return sorted(((t, *p) for t, (_, p) in pings.items() if p is not None), key=lambda x: x[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.clear()  # the watermark is past the slot: no ping of it can come any more
        return iter(())

    def close(self) -> None:
        pass


def _by_time(step):
    return step[0][0], step[1][0]


class VesselSteps(StatefulProcessor):
    """Edges of the slots of some vessels; key (group of vessels,). The group's timer is the earliest of its vessels' alerts."""

    def __init__(self, alert_us: int, slot_us: int):
        self.alert_us, self.slot_us = alert_us, slot_us

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("edges", "edges binary, alert bigint")

    def handleInputRows(self, key, rows, timerValues):
        vessels, timer = {}, 0
        if self.state.exists():
            packed, timer = self.state.get()
            vessels = pickle.loads(packed)  # vessel to (slot to (first ping, last ping), alert)
        before, newest, passed = {}, {}, []
        for frame in rows:
            frame = frame[COLUMNS]
            for vessel, at in frame.groupby("vessel", sort=False)["at"].max().items():
                newest[vessel] = max(newest.get(vessel, 0), int(at.value // 1000))
                if vessel not in before:
                    vessels.setdefault(vessel, ({}, 0))
                    before[vessel] = self._crossing(vessels[vessel][0])
            edges = frame[frame["kind"] == EDGE]
            last, first = (zip(*(_plain(edges[p + c]) for c in PING)) for p in ("", "prev_"))
            for vessel, slot, b, a in zip(edges["vessel"].tolist(), edges["slot"].tolist(), last, first):
                if b[0] is None:
                    vessels[vessel][0].pop(int(slot), None)
                else:
                    vessels[vessel][0][int(slot)] = (int(a[0]), *a[1:]), (int(b[0]), *b[1:])
            passed.append(frame[frame["kind"] == STEP])
        yield from (p for p in passed if len(p))
        out, watermark = [], timerValues.getCurrentWatermarkInMs()
        for vessel, was in before.items():
            edges, at = vessels[vessel][0], newest[vessel]
            now = self._crossing(edges)
            out += [_row(vessel, STEP, -1, None, *s, at) for s in sorted(was - now, key=_by_time)]
            out += [_row(vessel, STEP, 1, None, *s, at) for s in sorted(now - was, key=_by_time)]
            if edges:
                vessels[vessel] = edges, (edges[max(edges)][1][0] + self.alert_us) // 1000
                for s in sorted(s for s in edges if (s + 1) * self.slot_us // 1000 <= watermark)[:-1]:
                    del edges[s]
        self.state.update((pickle.dumps(vessels), self._earliest(vessels, timer)))
        if out:
            yield _frame(out)

    def _earliest(self, vessels, timer: int) -> int:
        """Moves the group's timer to the earliest alert (0: none)."""
        due = min((alert for _, alert in vessels.values() if alert), default=0)
        if due != timer:
            if timer:
                self.handle.deleteTimer(timer)
            if due:
                self.handle.registerTimer(due)
        return due

    @staticmethod
    def _crossing(edges) -> set[tuple]:
        slots = sorted(edges)
        return {(edges[b][0], edges[a][1]) for a, b in zip(slots, slots[1:])}

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            packed, timer = self.state.get()
            expired, watermark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
            if timer == expired:
                vessels, out = pickle.loads(packed), []
                for vessel, (edges, alert) in vessels.items():
                    if alert and edges and (alert == expired or alert < watermark):
                        last = edges[max(edges)][1]
                        out.append(_row(vessel, GAP_OPEN, 1, None, last, None, last[0] + self.alert_us))
                        vessels[vessel] = edges, 0
                self.state.update((pickle.dumps(vessels), self._earliest(vessels, 0)))
                if out:
                    yield _frame(out)

    def close(self) -> None:
        pass
