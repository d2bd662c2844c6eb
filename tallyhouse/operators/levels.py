"""Object levels: every fact row counts for its city, district, plate and house."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import schema as S

ALL_LEVELS = (S.OBJ_CITY, S.OBJ_DISTRICT, S.OBJ_PLATE, S.OBJ_HOUSE)

_KEY_COLUMN = {S.OBJ_DISTRICT: "district_id", S.OBJ_PLATE: "plate_id", S.OBJ_HOUSE: "house_id"}


def explode_levels(df: DataFrame, levels: Sequence[str] = ALL_LEVELS) -> DataFrame:
    """One output row per input row and level, with ``obj_type`` and ``obj_key``.

    The levels are siblings under the city (not a rollup), and a null district
    or plate is a group of its own, so this is a generator rather than
    GROUPING SETS (whose null keys would clash with real nulls).  The
    generator runs inside the map stage before any partial aggregation.
    """
    pairs = []
    for level in levels:
        key = F.lit(None).cast("string") if level == S.OBJ_CITY else F.col(_KEY_COLUMN[level]).cast("string")
        pairs.append(F.struct(F.lit(level).alias("obj_type"), key.alias("obj_key")))
    rest = [c for c in df.columns if c not in _KEY_COLUMN.values()]
    return df.select(*rest, F.inline(F.array(*pairs)))
