"""Feed specification: what identifies an entity, a cycle, a copy and a change."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FeedSpec:
    """Describes one snapshot feed.

    key        entity key columns (a station, a customer, a part)
    cycle      snapshot cycle column (timestamp/date); ``(key, cycle)`` is unique after dedup
    order      tie-break for copies of one ``(key, cycle)``: earliest wins (ascending,
               NULLs first); should end in columns that make it a total order
    compared   business columns whose change is recorded (null-safe comparison)
    static     quasi-static attributes kept in the dimension (C6)
    date_col   partition column of the history table (date of ``cycle``)
    lookback_days  how far back the last known state is looked up (None = unbounded)
    buckets    bucket widths (seconds, finest first) that split hot keys in neighbour
               lookups; after dedup a (key, bucket) holds at most one row per
               distinct cycle in it, so the first width should span many cycles
               (a bucket of one cycle makes every row an edge)
    """

    key: tuple[str, ...]
    cycle: str
    order: tuple[str, ...]
    compared: tuple[str, ...]
    static: tuple[str, ...] = ()
    date_col: str = "request_date"
    lookback_days: int | None = 7
    buckets: tuple[int, ...] = (86400,)
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def keys(self) -> list[str]:
        return list(self.key)

    def with_(self, **kw) -> "FeedSpec":
        d = {f: getattr(self, f) for f in self.__dataclass_fields__}
        d.update(kw)
        return FeedSpec(**d)


# Fixed values of the station availability feed: key, cycle, copy order and the
# eight compared business fields.
STATION_COMPARED = (
    "is_installed", "capacity", "numdocksavailable", "numbikesavailable",
    "mechanical", "ebike", "is_renting", "is_returning",
)
STATION_STATIC = (
    "name", "capacity", "lat", "lon", "nom_arrondissement_communes",
    "code_insee_commune", "station_opening_hours",
)

STATION_SPEC = FeedSpec(
    key=("stationcode",),
    cycle="request_timestamp",
    order=("kafka_timestamp",),
    compared=STATION_COMPARED,
    static=STATION_STATIC,
    date_col="request_date",
    lookback_days=7,
    buckets=(86400,),
)
