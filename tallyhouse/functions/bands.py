"""Area bands used to find a community's main floor-area segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Area band bounds (lower, upper], lookup in this order; an area
# outside all of them falls into the default band.
AREA_BANDS = (
    (0, 60), (60, 70), (70, 80), (80, 90), (90, 100), (100, 110), (110, 120),
    (120, 135), (135, 150), (150, 165), (165, 180), (180, 200), (200, 225),
    (225, 250), (250, 275), (275, 300), (300, 350), (350, 400), (400, 450),
    (450, 500), (500, 999999),
)
DEFAULT_BAND = (90, 100)


def band_lower(area: str) -> Column:
    """Lower bound of the area band of integer column ``area`` (identifies the band)."""
    c = "`" + area + "`"
    body = " ".join(f"WHEN {c} > {lo} AND {c} <= {hi} THEN {lo}" for lo, hi in AREA_BANDS)
    return F.expr(f"CASE {body} ELSE {DEFAULT_BAND[0]} END")


def band_upper_of(lower: str) -> Column:
    c = "`" + lower + "`"
    body = " ".join(f"WHEN {c} = {lo} THEN {hi}" for lo, hi in AREA_BANDS)
    return F.expr(f"CASE {body} END")
