"""Result schema and the label vocabulary of the metrics table."""

from __future__ import annotations

from pyspark.sql import types as T

# Segment, metric, object-level and period-type labels written to
# the metrics table.  Consumers of the table key on these exact strings.
DIM_NEW = "NEW"
DIM_SECOND = "SECOND"

INDEX_TOTAL_DEAL_VOLUME = "TOTAL_DEAL_VOLUME"
INDEX_DEAL_VOLUME = "DEAL_VOLUME"
INDEX_DEAL_PRICE_AVG = "DEAL_PRICE_AVG"
INDEX_QUOTED_VOLUME = "QUOTED_VOLUME"
INDEX_QUOTED_PRICE_AVG = "QUOTED_PRICE_AVG"

OBJ_CITY = "CITY"
OBJ_DISTRICT = "DISTRICT"
OBJ_PLATE = "PLATE"
OBJ_HOUSE = "HOUSE"

PERIOD_TYPE_MONTH = "Month"
PERIOD_TYPE_PERIOD = "Period"
PERIOD_TYPE_TOTAL = "Total"

# Columns of the metrics table, in table order (the partition column ``ds`` is
# added by the sink).
METRIC_COLUMNS = (
    "dim",
    "index",
    "obj_type",
    "obj_value",
    "period_type",
    "period_value",
    "current_result",
    "previous_result",
    "mom",
    "yoy",
)

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("dim", T.StringType(), False),
        T.StructField("index", T.StringType(), False),
        T.StructField("obj_type", T.StringType(), False),
        T.StructField("obj_value", T.StringType(), False),
        T.StructField("period_type", T.StringType(), False),
        T.StructField("period_value", T.StringType(), False),
        T.StructField("current_result", T.DoubleType(), False),
        T.StructField("previous_result", T.DoubleType(), True),
        T.StructField("mom", T.DoubleType(), True),
        T.StructField("yoy", T.DoubleType(), True),
    ]
)

# Grouping keys of every per-object aggregate: segment, level, city and the
# level's own key (null for CITY).  The printable ``obj_value`` label is built
# from these only at the end, so shuffles carry short keys.
OBJECT_KEYS = ("dim", "obj_type", "city_id", "obj_key")
