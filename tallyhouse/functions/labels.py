"""Object labels of the metrics table (``city:C``, ``city:C,district:D`` ...)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse import schema as S

# Label prefix of each object level below the city.
LEVEL_PREFIX = {
    S.OBJ_DISTRICT: ",district:",
    S.OBJ_PLATE: ",plate:",
    S.OBJ_HOUSE: ",house:",
}


def object_label(obj_type: str, city: str, key: str) -> Column:
    """``city:C`` plus ``,level:K`` below the city; a missing key is a real
    group and prints as the word null."""
    t, c, k = (f"`{n}`" for n in (obj_type, city, key))
    city_part = f"concat('city:', coalesce(CAST({c} AS STRING), 'null'))"
    body = f"WHEN {t} = '{S.OBJ_CITY}' THEN {city_part} " + " ".join(
        f"WHEN {t} = '{level}' THEN concat({city_part}, '{prefix}', coalesce(CAST({k} AS STRING), 'null'))"
        for level, prefix in LEVEL_PREFIX.items()
    )
    return F.expr(f"CASE {body} END")
