"""Display expressions: colours, money, badges, icons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from areascore.functions.fixed_values import (
    BADGE_DEFAULT,
    BADGES,
    NEUTRAL_SCORE,
    RAMP_ALPHA,
    RAMP_HIGH,
    RAMP_LOW,
    STATUS_ICON_DEFAULT,
    STATUS_ICONS,
)


def score_channels(col: Column) -> list[Column]:
    """Red, green and blue of a score on the low-high ramp, truncated to whole numbers."""
    known = F.when(col.isNull() | F.isnan(col), F.lit(float(NEUTRAL_SCORE))).otherwise(col)
    t = F.greatest(F.lit(0.0), F.least(F.lit(100.0), known)) / 100.0
    return [
        F.floor(low * (1 - t) + high * t).cast("int") for low, high in zip(RAMP_LOW, RAMP_HIGH)
    ]


def score_rgba(col: Column, alpha: int = RAMP_ALPHA) -> Column:
    return F.array(*score_channels(col), F.lit(alpha))


def display_money(col: Column) -> Column:
    """``$1,234``; missing and zero both show as N/A."""
    return F.when(col.isNull() | (col == 0), "N/A").otherwise(
        F.concat(F.lit("$"), F.format_number(F.floor(col + 0.5), 0))
    )


def _lookup(col: Column, table: dict[str, str], default: str) -> Column:
    out = None
    for key, icon in table.items():
        out = F.when(col == key, icon) if out is None else out.when(col == key, icon)
    return out.otherwise(default)


def badge(col: Column) -> Column:
    return F.concat(_lookup(col, BADGES, BADGE_DEFAULT), F.lit(" "), col)


def status_icon(col: Column) -> Column:
    """Icon and status; N/A when the run did not report that source."""
    shown = F.concat(_lookup(col, STATUS_ICONS, STATUS_ICON_DEFAULT), F.lit(" "), col)
    return F.coalesce(shown, F.lit("N/A"))
