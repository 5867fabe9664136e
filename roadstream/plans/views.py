"""The BI layer: four cast contracts and seven aggregate views.

Each view is declared once and rendered twice, as a DataFrame and as the SQL of a persistent
catalog view. A view that needs a dimension aggregates the fact on its natural keys first and
joins the attributes to the few result rows: the fact is never joined, so neither a hot zone
nor a dimension of unexpected size can hurt, and no broadcast hint is needed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.schemas import BI_CONTRACTS


def _percent(part: str) -> str:
    # Decimal division, so that a half rounds up exactly; DOUBLE is the published type.
    return f"cast(round(try_divide(100.0 * {part}, count(*)), 1) AS double)"


def _band(name: str) -> str:
    return f"sum(if(speed_band = '{name}', 1, 0))"


# Measures shared by the views: column name -> SQL aggregate over bi_fact_traffic.
AVG_CONGESTION = {"avg_congestion": "round(avg(congestion_level), 2)"}
AVG_SPEED = {"avg_speed": "round(avg(speed), 1)"}
PEAK_EVENTS = "sum(peak_flag)"


@dataclass(frozen=True)
class Dimension:
    table: str
    key: str
    attributes: tuple[str, ...]


@dataclass(frozen=True)
class View:
    source: str
    keys: tuple[str, ...]
    measures: Mapping[str, str]
    dimension: Dimension | None = None
    published: tuple[str, ...] = ()  # key and attribute order, where it is not keys first

    @property
    def columns(self) -> list[str]:
        attributes = self.dimension.attributes if self.dimension else ()
        return [*(self.published or (*self.keys, *attributes)), *self.measures]


VIEWS: dict[str, View] = {
    "v_hourly_congestion": View(
        "bi_fact_traffic",
        ("event_hour", "city_zone"),
        {**AVG_CONGESTION, **AVG_SPEED, "event_count": "count(*)"},
        Dimension("bi_dim_zone", "city_zone", ("zone_type",)),
        published=("event_hour", "zone_type", "city_zone"),
    ),
    "v_road_performance": View(
        "bi_fact_traffic",
        ("road_id",),
        {
            **AVG_SPEED,
            **AVG_CONGESTION,
            "total_events": "count(*)",
            "peak_hour_events": PEAK_EVENTS,
            "peak_pct": _percent(PEAK_EVENTS),
        },
        Dimension("bi_dim_road", "road_id", ("road_type", "speed_limit")),
    ),
    "v_weather_impact": View(
        "bi_fact_traffic",
        ("weather",),
        {
            **AVG_CONGESTION,
            **AVG_SPEED,
            "event_count": "count(*)",
            "pct_low_speed": _percent(_band("LOW")),
            "pct_high_speed": _percent(_band("HIGH")),
        },
    ),
    "v_speed_distribution": View(
        "bi_fact_traffic",
        ("city_zone", "speed_band"),
        {"vehicle_count": "count(*)", **AVG_CONGESTION},
    ),
    "v_zone_kpis": View(
        "bi_fact_traffic",
        ("city_zone",),
        {
            **AVG_SPEED,
            **AVG_CONGESTION,
            "unique_vehicles": "count(DISTINCT vehicle_id)",
            "total_events": "count(*)",
            "peak_events": PEAK_EVENTS,
            "first_event": "min(event_time)",
            "last_event": "max(event_time)",
        },
        Dimension("bi_dim_zone", "city_zone", ("zone_type", "traffic_risk")),
    ),
    "v_live_summary": View(
        "bi_fact_traffic",
        (),
        {
            "total_unique_vehicles": "count(DISTINCT vehicle_id)",
            "avg_speed_kmh": AVG_SPEED["avg_speed"],
            **AVG_CONGESTION,
            "total_events": "count(*)",
            "peak_hour_events": PEAK_EVENTS,
            "pct_low_speed_traffic": _percent(_band("LOW")),
        },
    ),
    "v_reject_monitoring": View(
        "bi_rejects",
        ("reject_reason",),
        {
            "rejected_rows": "count(*)",
            "first_seen": "min(rejected_at)",
            "last_seen": "max(rejected_at)",
        },
    ),
}


def contract_frame(name: str, table: DataFrame) -> DataFrame:
    """A cast contract as a DataFrame over its table."""
    _, columns = BI_CONTRACTS[name]
    return table.select(*[F.col(c).cast(kind).alias(alias) for c, alias, kind in columns])


def contract_sql(name: str, extra: Iterable[str] = ()) -> str:
    """A cast contract as SQL, ending with ``extra`` columns of its table as they are."""
    table, columns = BI_CONTRACTS[name]
    casts = [f"CAST({c} AS {kind}) AS {alias}" for c, alias, kind in columns]
    return f"SELECT {', '.join([*casts, *extra])} FROM {table}"


def view_frame(name: str, contracts: Mapping[str, DataFrame]) -> DataFrame:
    """A view as a DataFrame over the cast contracts."""
    view = VIEWS[name]
    measures = [F.expr(sql).alias(measure) for measure, sql in view.measures.items()]
    result = contracts[view.source].groupBy(*view.keys).agg(*measures)
    if view.dimension:
        wanted = contracts[view.dimension.table].select(
            view.dimension.key, *view.dimension.attributes
        )
        result = result.join(wanted, view.dimension.key)
    return result.select(*view.columns)


def view_sql(name: str) -> str:
    view = VIEWS[name]
    measures = [f"{sql} AS {measure}" for measure, sql in view.measures.items()]
    grouping = f" GROUP BY {', '.join(view.keys)}" if view.keys else ""
    grouped = f"SELECT {', '.join([*view.keys, *measures])} FROM {view.source}{grouping}"
    if not view.dimension:
        return grouped
    return (
        f"SELECT {', '.join(view.columns)} FROM ({grouped}) "
        f"JOIN {view.dimension.table} USING ({view.dimension.key})"
    )


def contracts(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All cast contracts over the given tables."""
    return {
        name: contract_frame(name, tables[table])
        for name, (table, _) in BI_CONTRACTS.items()
        if table in tables
    }


def all_views(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The whole BI layer: cast contracts and aggregate views."""
    bi = contracts(tables)
    return {**bi, **{name: view_frame(name, bi) for name in VIEWS}}
