"""Model graph: name -> (builder, dependencies, tags), evaluated lazily.

``ModelGraph(raw).get(name)`` returns the DataFrame of a model, building its
dependencies once per graph (the same DataFrame object is reused, so a
size check or hot-key probe runs once per graph, not once per consumer).
Nothing here executes a query except those bounded probes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from parcelspark.operators import intermediate as I
from parcelspark.operators import marts as M
from parcelspark.operators import reports as R
from parcelspark.operators import staging as S
from parcelspark.sources.fixtures import RawTables

HOURLY = "hourly"
DAILY = "daily"


@dataclass(frozen=True)
class Model:
    name: str
    build: Callable[..., DataFrame]
    deps: tuple[str, ...]
    tags: frozenset[str] = field(default_factory=frozenset)
    kind: str = "view"  # view | table | internal | report


def _m(name, build, deps, tags=(), kind="view") -> Model:
    return Model(name, build, tuple(deps), frozenset(tags), kind)


HD = (HOURLY, DAILY)
D = (DAILY,)

MODELS: dict[str, Model] = {
    m.name: m
    for m in [
        # raw inputs
        _m("raw_facilities", None, (), HD, "raw"),
        _m("raw_shipments", None, (), HD, "raw"),
        _m("raw_tracking_events", None, (), HD, "raw"),
        _m("raw_weather", None, (), D, "raw"),
        _m("status_codes_mapping", None, (), HD, "raw"),
        # staging
        _m("stg_facilities", S.stg_facilities, ["raw_facilities"], HD),
        _m("stg_shipments", S.stg_shipments, ["raw_shipments"], HD),
        _m("stg_tracking_events", S.stg_tracking_events, ["raw_tracking_events"], HD),
        _m("stg_weather_delays", S.stg_weather_delays, ["raw_weather"], D),
        # intermediate
        _m("int_shipments_enriched", I.int_shipments_enriched, ["stg_shipments", "stg_facilities"], HD),
        _m("shipments_without_facilities", I.shipments_without_facilities, ["stg_shipments", "stg_facilities"], D, "internal"),
        _m("tracking_with_status", I.tracking_with_status, ["stg_tracking_events", "status_codes_mapping"], HD, "internal"),
        _m("tracking_lag_full", I.int_tracking_with_lag, ["tracking_with_status"], HD, "internal"),
        _m("int_tracking_with_lag", I.published_tracking_with_lag, ["tracking_lag_full"], HD),
        # marts (tables)
        _m("mart_courier_issues_summary", M.mart_courier_issues_summary, ["stg_tracking_events"], D, "table"),
        _m("mart_daily_active_network", M.mart_daily_active_network, ["stg_tracking_events"], D, "table"),
        _m("mart_daily_revenue_summary", M.mart_daily_revenue_summary, ["shipments_without_facilities"], D, "table"),
        _m("mart_delivery_performance", M.mart_delivery_performance, ["shipments_without_facilities", "stg_tracking_events"], D, "table"),
        _m("mart_exceptions_analysis", M.mart_exceptions_analysis, ["int_shipments_enriched", "tracking_with_status", "status_codes_mapping"], HD, "table"),
        _m("mart_facility_bottlenecks", M.mart_facility_bottlenecks, ["stg_facilities", "tracking_lag_full"], D, "table"),
        _m("mart_facility_capacity_utilization", M.mart_facility_capacity_utilization, ["stg_facilities", "stg_tracking_events"], D, "table"),
        _m("mart_facility_traffic", M.mart_facility_traffic, ["stg_facilities", "stg_tracking_events"], D, "table"),
        _m("mart_financial_exposure", M.mart_financial_exposure, ["mart_exceptions_analysis"], D, "table"),
        _m("shipment_lifecycle_full", M.shipment_lifecycle, ["int_shipments_enriched", "tracking_lag_full"], D, "internal"),
        _m("mart_shipment_lifecycle", M.mart_shipment_lifecycle, ["shipment_lifecycle_full"], D, "table"),
        _m("mart_route_performance", M.mart_route_performance, ["shipment_lifecycle_full"], D, "table"),
        _m("mart_weather_impact", M.mart_weather_impact, ["stg_weather_delays", "stg_facilities", "tracking_with_status"], D, "table"),
        _m("mart_weight_brackets_pricing", M.mart_weight_brackets_pricing, ["shipments_without_facilities"], D, "table"),
        # read-outs
        _m("report_daily_revenue", R.report_daily_revenue, ["mart_daily_revenue_summary"], D, "report"),
        _m("report_top_routes", R.report_top_routes, ["mart_route_performance"], D, "report"),
        _m("report_top_facilities", R.report_top_facilities, ["mart_facility_traffic"], D, "report"),
        _m("report_exceptions_breakdown", R.report_exceptions_breakdown, ["mart_exceptions_analysis"], D, "report"),
        _m("report_weight_pricing", R.report_weight_pricing, ["mart_weight_brackets_pricing"], D, "report"),
    ]
}

MART_NAMES = [n for n, m in MODELS.items() if m.kind == "table"]
REPORT_NAMES = [n for n, m in MODELS.items() if m.kind == "report"]


def _raw_map(raw: RawTables) -> dict[str, DataFrame]:
    return {
        "raw_facilities": raw.facilities,
        "raw_shipments": raw.shipments,
        "raw_tracking_events": raw.tracking_events,
        "raw_weather": raw.weather,
        "status_codes_mapping": raw.status_codes,
    }


def topo_order(names: list[str]) -> list[str]:
    """Dependency order of ``names`` and everything they need."""
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in MODELS[n].deps:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def select_by_tag(tag: str, kinds: tuple[str, ...] = ("table",)) -> list[str]:
    return [n for n, m in MODELS.items() if tag in m.tags and m.kind in kinds]


class ModelGraph:
    """Lazily evaluated model graph over one set of raw tables.

    ``overrides`` lets a job substitute a materialized (written and re-read)
    frame for a model, e.g. the lag model that nine marts share.
    """

    def __init__(self, raw: RawTables, overrides: dict[str, DataFrame] | None = None):
        self._frames: dict[str, DataFrame] = dict(_raw_map(raw))
        self._frames.update(overrides or {})

    def set(self, name: str, df: DataFrame) -> None:
        self._frames[name] = df

    def get(self, name: str) -> DataFrame:
        if name not in self._frames:
            model = MODELS[name]
            args = [self.get(d) for d in model.deps]
            self._frames[name] = model.build(*args)
        frame = self._frames[name]
        if callable(frame):  # lazily supplied raw input
            frame = self._frames[name] = frame()
        return frame
