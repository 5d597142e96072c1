"""Per-user sequence features on a stream: keyed state instead of windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

RADIUS = 6371.0
HOUR = 3600
OUTPUT = ("login_id long, user_id long, ts timestamp, minutes_since_last_login double, distance_from_prev_km double, "
          "geo_velocity_kmh double, logins_last_hour long, is_new_device int, is_late int")
#: what the stream must be started with: a state store with lists and maps, and no endless empty batches that only look for expired state
SETTINGS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
            "spark.sql.streaming.noDataMicroBatches.enabled": "false"}


def _km(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Distance of each position from the one before it."""
    a, b = np.radians(lat), np.radians(lon)
    h = np.sin(np.diff(a) / 2) ** 2 + np.cos(a[:-1]) * np.cos(a[1:]) * np.sin(np.diff(b) / 2) ** 2
    return 2 * RADIUS * np.arcsin(np.sqrt(np.minimum(1.0, h)))


class UserFeatures(StatefulProcessor):
    """State of one user: the newest event (a value), the seconds of the recent hours with events in them (a list), and the
    devices seen before the cutoff (a map). Each is written by itself, so one new device is one write."""

    def __init__(self, cutoff: str, recent_hours: int, idle_ms: int | None, device_ms: int | None):
        self.until = pd.Timestamp(cutoff)
        self.window, self.idle_ms, self.device_ms = recent_hours * HOUR, idle_ms, device_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "s long, lat double, lon double")
        self.recent = handle.getListState("recent", "s long, n long, lat double, lon double", self.idle_ms)
        self.devices = handle.getMapState("devices", "device string", "first_s long", self.device_ms)

    def _known(self, rows: pd.DataFrame, now: np.ndarray, first_time: bool) -> np.ndarray:
        """Whether each event's device is among the user's devices; early events add theirs first."""
        known: dict[str, bool] = {}
        early = rows["ts"].to_numpy() < self.until.to_datetime64()
        names = rows["device"].to_numpy(object)
        for name in pd.unique(rows["device"].dropna()):
            known[name] = not first_time and self.devices.containsKey((name,))
            first = now[early & (names == name)]
            if not known[name] and len(first):
                self.devices.updateValue((name,), (int(first[0]),))
                known[name] = True
        return np.array([known.get(x, False) for x in names], bool)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(rows)).sort_values(["ts", "login_id"])
        now = rows["ts"].to_numpy("datetime64[s]").astype(np.int64)
        newest = self.newest.get()  # never expires: without it the user is new and has no other state
        held = [] if newest is None else [tuple(r) for r in self.recent.get()]
        stored = len(held)
        if newest is not None and all(r[0] != newest[0] for r in held):
            held.append((newest[0], 0, newest[1], newest[2]))  # the list has expired: the newest event is still the one before
        old = np.array([[np.nan if v is None else v for v in r] for r in held], float).reshape(-1, 4)
        # stored seconds and new events in time order, stored ones first within a second
        times = np.concatenate((old[:, 0].astype(np.int64), now))
        weight = np.concatenate((old[:, 1].astype(np.int64), np.ones(len(now), np.int64)))
        lats = np.concatenate((old[:, 2], rows["latitude"].to_numpy(float)))
        lons = np.concatenate((old[:, 3], rows["longitude"].to_numpy(float)))
        order = np.argsort(times, kind="stable")
        times, weight, lats, lons, new = times[order], weight[order], lats[order], lons[order], order >= len(old)
        before = lambda x: np.concatenate(([np.nan], x))
        gap, km = np.diff(before(times)) / 60.0, _km(before(lats), before(lons))
        speed = np.divide(km, gap / 60.0, out=np.full(len(gap), np.nan), where=gap > 0)
        upto = np.concatenate(([0], np.cumsum(weight)))
        in_hour = upto[np.searchsorted(times, times, "right")] - upto[np.searchsorted(times, times - HOUR, "left")]
        late = now < (newest[0] if newest is not None else now[0])

        seconds, first = np.unique(times, return_index=True)
        last = np.append(first[1:], len(times)) - 1
        keep = seconds >= times[-1] - self.window
        counts = np.add.reduceat(weight, first)
        entries = [(int(s), int(n), *(None if np.isnan(v) else float(v) for v in (a, b)))
                   for s, n, a, b in zip(seconds[keep], counts[keep], lats[last[keep]], lons[last[keep]])]
        in_order = not stored or now[0] > held[stored - 1][0]
        if stored and in_order and held[0][0] >= times[-1] - 2 * self.window:
            self.recent.appendList([e for e in entries if e[0] >= now[0]])  # only what is new; old seconds go when they are many
        else:
            self.recent.put(entries)
        if newest is None or times[-1] >= newest[0]:
            self.newest.update(tuple(None if v != v else v for v in (int(times[-1]), float(lats[-1]), float(lons[-1]))))
        numbers = {"minutes_since_last_login": gap, "distance_from_prev_km": km, "geo_velocity_kmh": speed}
        yield pd.DataFrame({
            "login_id": rows["login_id"].to_numpy(), "user_id": rows["user_id"].to_numpy(), "ts": rows["ts"].to_numpy(),
            **{c: pd.array([None if np.isnan(x) else x for x in v[new]], dtype="Float64") for c, v in numbers.items()},
            "logins_last_hour": in_hour[new], "is_new_device": (~self._known(rows, now, newest is None)).astype("int32"), "is_late": late.astype("int32")})

    def close(self) -> None:
        pass


def user_features_stream(df: DataFrame, cutoff: str, idle_days: float | None = 30.0, recent_hours: int = 24,
                         device_days: float | None = None) -> DataFrame:
    """Gap, distance, speed, events in the last hour and new-device flag of every event, whenever it arrives.

    No event is dropped: there is no watermark. Within a micro-batch events are put in (time, id) order, so results equal the batch
    features when batches arrive in time order. An event that arrives after newer ones of its user (``is_late``) is
    compared with the event before it if that lies in the user's last ``recent_hours``, and has no gap, distance and speed if not;
    what was already written for newer events stays as it is.

    The recent hours expire ``idle_days`` after their last write (processing time; None: never). The newest event stays, so a user who
    returns has a gap and a distance. Devices stay too, unless ``device_days`` is set. A later micro-batch of an idle
    user costs three small reads; a new device is one write, whatever the number of known ones. Start the stream with ``SETTINGS``.
    """
    ms = lambda days: None if days is None else max(int(days * 86_400_000), 1)
    source = df.select("login_id", "user_id", "ts", "latitude", "longitude", "device")
    return source.groupBy("user_id").transformWithStateInPandas(
        UserFeatures(cutoff, recent_hours, ms(idle_days), ms(device_days)), OUTPUT, "append", "None" if idle_days is None and device_days is None else "ProcessingTime")
