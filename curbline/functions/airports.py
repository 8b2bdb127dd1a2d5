"""Airport boxes: a trip end belongs to an airport when it lies in its box."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline import schema as S


def airport_named(name: str) -> dict:
    return next(a for a in S.AIRPORTS if a["name"] == name)


def in_box(lat: str, lon: str, airport: dict, half_width: float | None = None) -> Column:
    """Closed box around an airport; its own radius decides the default size."""
    if half_width is None:
        half_width = airport["radius_miles"] * S.DEGREES_PER_RADIUS_MILE
    return F.col(lat).between(airport["lat"] - half_width, airport["lat"] + half_width) & F.col(
        lon
    ).between(airport["lon"] - half_width, airport["lon"] + half_width)


def airport_label(side: str, airports=None, half_width: float | None = None) -> Column:
    """Name of the first airport whose box holds the trip end, else NULL.

    ``side`` is ``"pickup"`` or ``"dropoff"``.
    """
    hits = [
        F.when(in_box(f"{side}_latitude", f"{side}_longitude", a, half_width), F.lit(a["name"]))
        for a in (airports or S.AIRPORTS)
    ]
    return F.coalesce(*hits)


def airport_trips(trips: DataFrame, airports=None, half_width: float | None = None) -> DataFrame:
    """Trips with an airport end, plus ``airport_name`` and ``direction``.

    The pickup airport wins when both ends are airports.
    """
    both = trips.withColumns(
        {
            "pickup_airport": airport_label("pickup", airports, half_width),
            "dropoff_airport": airport_label("dropoff", airports, half_width),
        }
    )
    return both.withColumns(
        {
            "airport_name": F.coalesce("pickup_airport", "dropoff_airport"),
            "direction": F.when(F.col("pickup_airport").isNotNull(), "from_airport").otherwise("to_airport"),
        }
    ).where(F.col("airport_name").isNotNull())
