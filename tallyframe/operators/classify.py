"""Business classifiers: aging buckets, labels, flags and segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.dates import run_date

# Days-past-due columns of the portfolio tables (name, first day, last day).
AGING_BANDS: tuple[tuple[str, int | None, int | None], ...] = (
    ("por_vencer", 0, 0),
    ("mora_1_a_30", 1, 30),
    ("mora_31_a_60", 31, 60),
    ("mora_61_a_90", 61, 90),
    ("mora_91_a_120", 91, 120),
    ("mora_121_a_180", 121, 180),
    ("mora_181_a_360", 181, 360),
    ("mora_mayor_360", 361, None),
    ("morageneral", 1, None),
    ("mora_30", 31, None),
)


def in_band(value: Column, low: int | None, high: int | None) -> Column:
    if high is None:
        return value >= low
    if low is None:
        return value <= high
    return value.between(low, high)


def aging_columns(days: Column, balance: Column, bands=AGING_BANDS) -> list[Column]:
    """The balance in the column of its band, 0 in the others. Null days age nowhere."""
    return [
        F.when(in_band(days, low, high), balance).otherwise(F.lit(0)).alias(name)
        for name, low, high in bands
    ]


def aging_buckets(df: DataFrame, days: str, balance: str, bands=AGING_BANDS) -> DataFrame:
    return df.select("*", *aging_columns(F.col(days), F.col(balance), bands))


# Life-cycle texts of the originations table.
LIFECYCLE_LABELS = {
    "same_day": "Desembolsado y Cancelado el Mismo Dia",
    "same_month": "Desembolsado y Cancelado el Mismo Mes",
    "open": "Desembolso No Cancelado",
    "later": "Desembolso Cancelado Posterior a la Fecha de Consulta",
}
ACTIVITY_LABELS = {"same_day": "No Activo", "same_month": "No Activo", "open": "Activo", "later": "Activo"}


def lifecycle_label(opened: Column, closed: Column, as_of: date | str, labels=LIFECYCLE_LABELS) -> Column:
    """First rule that holds: same day, same month end, no close date, closed later."""
    return (
        F.when(opened == closed, labels["same_day"])
        .when(F.last_day(opened) == F.last_day(closed), labels["same_month"])
        .when(closed.isNull(), labels["open"])
        .when(closed > run_date(as_of), labels["later"])
    )


def freshness_label(
    updated: Column, as_of: date | str, days: int = 365, fresh: str = "Actualizado", stale: str = "Desactualizado"
) -> Column:
    """Stale when the update is older than ``days``; an unknown date counts as fresh."""
    return F.when(F.datediff(run_date(as_of), updated) > days, stale).otherwise(fresh)


def code_to_label(code: Column, labels: Mapping[object, str], default: str | None = None) -> Column:
    chain = F
    for value, label in labels.items():
        chain = chain.when(code == F.lit(value), F.lit(label))
    return chain.otherwise(F.lit(default))


def yes_no(flag: Column, yes: str = "SI", no: str = "NO") -> Column:
    return F.when(flag, yes).otherwise(no)


@dataclass(frozen=True)
class Segment:
    """1 when the amount lies between wage * low and wage * high."""

    name: str
    low: Column
    high: Column
    low_open: bool = False
    when: Column | None = None


def threshold_segments(amount: Column, wage: Column, segments: Sequence[Segment]) -> list[Column]:
    out = []
    for s in segments:
        above = amount > wage * s.low if s.low_open else amount >= wage * s.low
        hit = above & (amount <= wage * s.high)
        if s.when is not None:
            hit = s.when & hit
        out.append(F.when(hit, 1).otherwise(0).alias(s.name))
    return out


@dataclass(frozen=True)
class Route:
    """The value to take for one (module, transaction) code pair."""

    module: object
    transactions: tuple
    value: Column


def transaction_router(module: Column, transaction: Column, routes: Sequence[Route], default: Column) -> Column:
    """First route whose code pair fits, else the default."""
    chain = F
    for r in routes:
        chain = chain.when((module == F.lit(r.module)) & transaction.isin(*r.transactions), r.value)
    return chain.otherwise(default)


def name_fallback_if_numeric(name: Column, other: Column) -> Column:
    """``other`` where the name is missing or only a number."""
    return F.when(name.isNull() | name.try_cast("double").isNotNull(), other).otherwise(name)
