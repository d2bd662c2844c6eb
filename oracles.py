"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code: the test-data adapters are restated
as CTEs, windows come from a VALUES table joined by range, and every metric is
a plain GROUP BY over the rows.  Both sides round results to 6 decimals.
"""

from __future__ import annotations

AS_OF = "DATE '2001-11-05'"
DS = "'2001-11-04'"


def _day(x: str) -> str:
    """The date before the first blank; null unless that is a date and nothing else."""
    part = f"split_part({x}, ' ', 1)"
    return f"CASE WHEN regexp_full_match({part}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST({part} AS DATE) END"


def _r(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


ADAPTERS = f"""
dim AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS biz_city_id, CAST(s_suppkey AS VARCHAR) AS biz_house_id,
         CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE CAST(s_suppkey % 4 AS VARCHAR) END AS biz_district_id,
         CASE WHEN s_suppkey % 11 = 0 THEN 'p'
              ELSE CAST(s_nationkey AS VARCHAR) || '@' || CAST(s_suppkey % 6 AS VARCHAR) END AS plate_fk,
         CAST(1 + s_suppkey % 2 AS INTEGER) AS is_first
  FROM supplier
  UNION ALL
  SELECT CAST(s_nationkey AS VARCHAR), CAST(s_suppkey AS VARCHAR),
         CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE CAST(s_suppkey % 4 AS VARCHAR) END,
         CASE WHEN s_suppkey % 11 = 0 THEN 'p'
              ELSE CAST(s_nationkey AS VARCHAR) || '@' || CAST(s_suppkey % 6 AS VARCHAR) END,
         CAST(2 - s_suppkey % 2 AS INTEGER)
  FROM supplier WHERE s_suppkey % 10 = 0
  UNION ALL
  SELECT CAST(s_nationkey AS VARCHAR), CAST(s_suppkey AS VARCHAR),
         CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE CAST(s_suppkey % 4 AS VARCHAR) END,
         CASE WHEN s_suppkey % 11 = 0 THEN 'p'
              ELSE CAST(s_nationkey AS VARCHAR) || '@' || CAST(s_suppkey % 6 AS VARCHAR) END,
         code
  FROM supplier, (VALUES (NULL, 7, 3), (3, 9, 4)) AS odd(code, m, r) WHERE s_suppkey % m = r
),
li AS (
  SELECT l.*, s.s_nationkey, s.s_suppkey,
         CAST(l_shipdate AS DATE) - CAST((s_suppkey % 12) * 40 AS INTEGER)
           + CASE WHEN s_suppkey % 24 = 0 THEN 5 ELSE 0 END AS dd
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
deal AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS city_id, CAST(s_suppkey AS VARCHAR) AS house_id,
         strftime(dd, '%Y-%m-%d') AS bargaindate,
         head || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || CASE WHEN more THEN '345' ELSE '' END AS totalprice,
         head || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS VARCHAR)
           || CASE WHEN more THEN '5' ELSE '' END AS eval_totalprice,
         CASE l_linenumber % 4 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '行情参考' END AS price_label,
         head || CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) || CASE WHEN more THEN '125' ELSE '' END AS bargain_area,
         CASE WHEN l_linenumber = 7 THEN '2001-11-03' ELSE '2001-11-04' END AS ds
  FROM (SELECT *, CASE WHEN l_partkey % 97 = 5 THEN '1234567890' ELSE '' END AS head,
               l_partkey % 97 = 5 OR l_partkey % 89 = 7 AS more FROM li) x
),
listing AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS city_id, CAST(s_suppkey AS VARCHAR) AS house_id,
         strftime(dd - CAST(10 + l_partkey % 1500 AS INTEGER), '%Y-%m-%d') || suffix AS first_pub_date,
         CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE strftime(dd, '%Y-%m-%d') END AS last_pub_date,
         CAST(ar AS VARCHAR) || CASE WHEN l_partkey % 89 = 7 THEN '.12345' ELSE '' END AS area,
         CAST(ar * CASE WHEN l_partkey % 50 = 1 THEN 90000 ELSE uc END AS VARCHAR) AS quoted_price,
         CASE WHEN l_partkey % 37 = 0 THEN NULL
              ELSE CAST(ar * uc * (1 + 12 * CAST(l_discount AS DECIMAL(4,2))) AS VARCHAR) END AS evaluation_high_price,
         CAST(p_size * 25 AS VARCHAR) AS total_floors,
         CAST(l_linenumber AS VARCHAR) AS status,
         '2001-11-04' AS ds
  FROM (
    SELECT li.*, p_size, 30 + CAST(l_quantity AS BIGINT) AS ar,
           1500000 + (s_suppkey % 7) * 100000 + ((l_partkey * l_partkey) % 97) * 2000
             + CASE WHEN s_suppkey % 3 = 0 THEN (l_partkey % 9) * (l_partkey % 9) * 60000 ELSE 0 END AS uc
    FROM li JOIN part ON l_partkey = p_partkey
  ) x, (VALUES (0), (1)) AS variant(broken),
  LATERAL (SELECT CASE WHEN broken = 1 THEN CASE WHEN l_partkey % 2 = 0 THEN '99' ELSE 'garbage' END
                       WHEN l_partkey % 5 = 0 THEN ' 10:00:00' ELSE '' END AS suffix)
  WHERE broken = 0 OR l_partkey % 41 = 0
),
release AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id,
         CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE DATE '2001-06-15' - CAST(31 * n_nationkey AS INTEGER) END AS new_updated,
         CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE DATE '2001-06-15' - CAST(31 * n_nationkey AS INTEGER) END AS second_updated
  FROM nation
),
periods(pname, lo, hi, s_off, ps_off, pe_off) AS (
  VALUES ('Yesterday', 1, 1, 1, 2, 2), ('SevenDays', 2, 7, 7, 14, 8), ('ThirtyDays', 8, 30, 30, 60, 31),
         ('SixtyDays', 31, 60, 60, 120, 61), ('NinetyDays', 61, 90, 90, 180, 91),
         ('SixMonths', 91, 180, 180, 360, 181), ('OneYear', 181, 360, 360, 720, 361)
)"""


def _label(obj_type: str = "obj_type", city: str = "city_id", key: str = "obj_key") -> str:
    return (
        f"'city:' || coalesce({city}, 'null') || CASE {obj_type} WHEN 'CITY' THEN '' "
        f"WHEN 'DISTRICT' THEN ',district:' || coalesce({key}, 'null') "
        f"WHEN 'PLATE' THEN ',plate:' || coalesce({key}, 'null') "
        f"ELSE ',house:' || coalesce({key}, 'null') END"
    )


DEAL_ENRICHED = f"""
enriched AS (
  SELECT CASE WHEN CAST(b.is_first AS VARCHAR) = '1' THEN 'NEW' ELSE 'SECOND' END AS dim,
         a.city_id, b.biz_district_id AS district_id, split(b.plate_fk, '@')[2] AS plate_id, a.house_id,
         {_day("a.bargaindate")} AS deal_day,
         TRY_CAST(CASE WHEN CAST(b.is_first AS VARCHAR) = '2' AND a.price_label IN ('2', '行情参考')
                       THEN a.eval_totalprice ELSE a.totalprice END AS DECIMAL(28,8)) AS price,
         TRY_CAST(a.bargain_area AS DECIMAL(28,8)) AS area
  FROM deal a JOIN dim b ON a.city_id = b.biz_city_id AND a.house_id = b.biz_house_id
  WHERE a.ds = {DS} AND CAST(b.is_first AS VARCHAR) IN ('1', '2')
)"""


def deal_metrics_sql(calendar_months: bool = False) -> str:
    prev_end = (
        "CAST(last_day(CAST(m_day AS DATE) - INTERVAL 1 MONTH) AS DATE)"
        if calendar_months
        else "CAST(last_day(m_day) - INTERVAL 1 MONTH AS DATE)"
    )
    return f"""
WITH {ADAPTERS},
{DEAL_ENRICHED},
lv AS (
  SELECT dim, 'CITY' AS obj_type, city_id, CAST(NULL AS VARCHAR) AS obj_key, deal_day, price, area FROM enriched
  UNION ALL SELECT dim, 'DISTRICT', city_id, district_id, deal_day, price, area FROM enriched
  UNION ALL SELECT dim, 'PLATE', city_id, plate_id, deal_day, price, area FROM enriched
  UNION ALL SELECT dim, 'HOUSE', city_id, house_id, deal_day, price, area FROM enriched
),
rel AS (
  SELECT CAST(city_id AS VARCHAR) AS rel_city, max(second_updated) AS release_day
  FROM release WHERE second_updated IS NOT NULL GROUP BY 1
),
w AS (
  SELECT lv.*, max(deal_day) OVER (PARTITION BY dim, obj_type, city_id, obj_key) AS latest,
         (price IS NOT NULL AND area IS NOT NULL) AS valid
  FROM lv
),
wp AS (
  SELECT w.*, p.pname,
         {AS_OF} - p.s_off AS cs, {AS_OF} - 1 AS ce, {AS_OF} - p.ps_off AS ps, {AS_OF} - p.pe_off AS pe,
         CASE WHEN dim = 'NEW' THEN NULL WHEN obj_type = 'HOUSE' THEN latest ELSE rel.release_day END AS m_day
  FROM w
  LEFT JOIN periods p ON date_diff('day', w.latest, {AS_OF}) BETWEEN p.lo AND p.hi
  LEFT JOIN rel ON w.city_id = rel.rel_city
),
wm AS (
  SELECT wp.*,
         strftime(m_day, '%Y-%m') AS m_name,
         CAST(date_trunc('month', m_day) AS DATE) AS ms, CAST(last_day(m_day) AS DATE) AS me,
         CAST(date_trunc('month', m_day) - INTERVAL 1 MONTH AS DATE) AS mps, {prev_end} AS mpe
  FROM wp
),
agg AS (
  SELECT dim, obj_type, city_id, obj_key, count(*) AS total,
         max(pname) AS price_period,
         count(*) FILTER (WHERE deal_day BETWEEN cs AND ce) AS n_cur,
         sum(price) FILTER (WHERE deal_day BETWEEN cs AND ce AND valid) AS sp_cur,
         sum(area) FILTER (WHERE deal_day BETWEEN cs AND ce AND valid) AS sa_cur,
         count(*) FILTER (WHERE deal_day BETWEEN ps AND pe) AS n_prev,
         sum(price) FILTER (WHERE deal_day BETWEEN ps AND pe AND valid) AS sp_prev,
         sum(area) FILTER (WHERE deal_day BETWEEN ps AND pe AND valid) AS sa_prev,
         CASE WHEN dim = 'NEW' THEN max(pname) ELSE max(m_name) END AS volume_period,
         CASE WHEN dim = 'NEW' THEN count(*) FILTER (WHERE deal_day BETWEEN cs AND ce)
              ELSE count(*) FILTER (WHERE deal_day BETWEEN ms AND me) END AS v_cur,
         CASE WHEN dim = 'NEW' THEN count(*) FILTER (WHERE deal_day BETWEEN ps AND pe)
              ELSE count(*) FILTER (WHERE deal_day BETWEEN mps AND mpe) END AS v_prev
  FROM wm GROUP BY dim, obj_type, city_id, obj_key
),
prices AS (
  SELECT *,
         CASE WHEN n_cur > 0 THEN CAST(sp_cur AS DOUBLE) / NULLIF(CAST(sa_cur AS DOUBLE), 0) END AS p_cur,
         CASE WHEN n_prev > 0 THEN CAST(sp_prev AS DOUBLE) / NULLIF(CAST(sa_prev AS DOUBLE), 0) END AS p_prev,
         CASE WHEN v_cur > 0 THEN CAST(v_cur AS DOUBLE) END AS q_cur,
         CASE WHEN v_prev > 0 THEN CAST(v_prev AS DOUBLE) END AS q_prev,
         {_label()} AS obj_value
  FROM agg
),
metrics AS (
  SELECT dim, 'TOTAL_DEAL_VOLUME' AS "index", obj_type, obj_value, 'Total' AS period_type, 'Total' AS period_value,
         CAST(total AS DOUBLE) AS current_result, CAST(NULL AS DOUBLE) AS previous_result, CAST(NULL AS DOUBLE) AS mom
  FROM prices
  UNION ALL
  SELECT dim, 'DEAL_PRICE_AVG', obj_type, obj_value, 'Period', price_period, p_cur, p_prev,
         (p_cur - p_prev) * 100.0 / NULLIF(p_prev, 0)
  FROM prices WHERE price_period IS NOT NULL AND p_cur IS NOT NULL
  UNION ALL
  SELECT dim, 'DEAL_VOLUME', obj_type, obj_value, CASE WHEN dim = 'NEW' THEN 'Period' ELSE 'Month' END,
         volume_period, q_cur, q_prev, (q_cur - q_prev) * 100.0 / NULLIF(q_prev, 0)
  FROM prices WHERE volume_period IS NOT NULL AND q_cur IS NOT NULL
)
SELECT dim, "index", obj_type, obj_value, period_type, period_value,
       {_r('current_result')} AS current_result, {_r('previous_result')} AS previous_result,
       {_r('mom')} AS mom, CAST(NULL AS DOUBLE) AS yoy
FROM metrics"""


def deal_enriched_sql() -> str:
    return f"""
WITH {ADAPTERS},
{DEAL_ENRICHED}
SELECT dim, city_id, district_id, plate_id, house_id, deal_day,
       CAST(price AS VARCHAR) AS price, CAST(area AS VARCHAR) AS area
FROM enriched"""


def where(sql: str, cond: str) -> str:
    return f"SELECT * FROM ({sql}) q WHERE {cond}"


BANDS = """
bands(b_lo, b_hi) AS (
  VALUES (0, 60), (60, 70), (70, 80), (80, 90), (90, 100), (100, 110), (110, 120), (120, 135), (135, 150),
         (150, 165), (165, 180), (180, 200), (200, 225), (225, 250), (250, 275), (275, 300), (300, 350),
         (350, 400), (400, 450), (450, 500), (500, 999999)
)"""

# Braces doubled: LISTING_CLEAN is formatted once more.
_first, _last = (_day(f"a.{c}").replace("{", "{{").replace("}", "}}") for c in ("first_pub_date", "last_pub_date"))

LISTING_CLEAN = f"""
clean0 AS (
  SELECT a.city_id, b.biz_district_id AS district_id, split(b.plate_fk, '@')[2] AS plate_id, a.house_id,
         {_first} AS first_day,
         CASE WHEN a.last_pub_date IS NULL THEN {_first}
              WHEN {_last} >= {AS_OF} THEN {AS_OF} - 1 ELSE {_last} END AS end_day,
         TRY_CAST(a.quoted_price AS DECIMAL(28,8)) * 0.01 AS price_yuan,
         TRY_CAST(a.area AS DECIMAL(28,8)) AS area,
         CAST(floor(TRY_CAST(a.quoted_price AS DECIMAL(28,8))) AS BIGINT) AS cents_int,
         CAST(floor(TRY_CAST(a.area AS DOUBLE)) AS BIGINT) AS area_int
  FROM listing a JOIN dim b ON a.city_id = b.biz_city_id AND a.house_id = b.biz_house_id
  WHERE a.ds = {DS} AND a.status IN ('3', '5', '7') AND {{segment}}
    AND floor(TRY_CAST(a.total_floors AS DOUBLE)) < 1000
    AND floor(TRY_CAST(a.area AS DOUBLE)) > 0 AND floor(TRY_CAST(a.area AS DOUBLE)) < 1000
    AND TRY_CAST(a.quoted_price AS DOUBLE) / NULLIF(TRY_CAST(a.area AS DOUBLE), 0) BETWEEN 100000 AND 50000000
    AND TRY_CAST(a.evaluation_high_price AS DOUBLE) / NULLIF(TRY_CAST(a.quoted_price AS DOUBLE), 0) <= 2
    AND {_first} < {AS_OF}
),
clean AS (
  SELECT c.*, (cents_int // 100) // area_int AS u, coalesce(bd.b_lo, 90) AS band_lo
  FROM clean0 c LEFT JOIN bands bd ON c.area_int > bd.b_lo AND c.area_int <= bd.b_hi
)"""


def listing_clean_sql() -> str:
    return f"""
WITH {ADAPTERS}, {BANDS},
{LISTING_CLEAN.format(segment="TRUE")}
SELECT city_id, district_id, plate_id, house_id, first_day, end_day,
       {_r('price_yuan')} AS price_yuan, {_r('area')} AS area, u, band_lo
FROM clean"""


def listing_metrics_sql(previous: str = "cover", area_bands: str = "all", emit_plate: bool = False,
                        segment: str = "TRUE") -> str:
    prev = "first_day <= ps AND end_day >= pe" if previous == "cover" else "first_day <= pe AND end_day >= ps"
    plate = (
        "UNION ALL SELECT 'PLATE', city_id, plate_id, first_day, end_day, price_yuan, area, u, band_lo FROM clean"
        if emit_plate else ""
    )
    if area_bands == "dominant":
        main = """
bandn AS (SELECT city_id, obj_key, kind, band_lo, count(*) AS band_n FROM hn WHERE n > 3 GROUP BY ALL),
bandc AS (
  SELECT *, sum(band_n) OVER (PARTITION BY city_id, obj_key, kind ORDER BY band_n DESC, band_lo ASC
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cum_before
  FROM bandn
),
main AS (
  SELECT hn.* FROM hn JOIN bandc USING (city_id, obj_key, kind, band_lo)
  WHERE hn.n > 3 AND coalesce(bandc.cum_before, 0) * 2 <= hn.n
),"""
    else:
        main = "main AS (SELECT * FROM hn WHERE n > 3),"
    return f"""
WITH {ADAPTERS}, {BANDS},
{LISTING_CLEAN.format(segment=segment)},
lv AS (
  SELECT 'CITY' AS obj_type, city_id, CAST(NULL AS VARCHAR) AS obj_key, first_day, end_day, price_yuan, area, u, band_lo
  FROM clean
  UNION ALL SELECT 'DISTRICT', city_id, district_id, first_day, end_day, price_yuan, area, u, band_lo FROM clean
  {plate}
  UNION ALL SELECT 'HOUSE', city_id, house_id, first_day, end_day, price_yuan, area, u, band_lo FROM clean
),
w AS (SELECT lv.*, max(end_day) OVER (PARTITION BY obj_type, city_id, obj_key) AS latest FROM lv),
wp AS (
  SELECT w.*, p.pname, {AS_OF} - p.s_off AS cs, {AS_OF} - 1 AS ce, {AS_OF} - p.ps_off AS ps, {AS_OF} - p.pe_off AS pe
  FROM w JOIN periods p ON date_diff('day', w.latest, {AS_OF}) BETWEEN p.lo AND p.hi
),
flag AS (SELECT wp.*, (first_day <= ce AND end_day >= cs) AS in_cur, ({prev}) AS in_prev FROM wp),
agg AS (
  SELECT obj_type, city_id, obj_key, max(pname) AS period,
         count(*) FILTER (WHERE in_cur) AS n_cur,
         sum(price_yuan) FILTER (WHERE in_cur) AS y_cur, sum(area) FILTER (WHERE in_cur) AS a_cur,
         count(*) FILTER (WHERE in_prev) AS n_prev,
         sum(price_yuan) FILTER (WHERE in_prev) AS y_prev, sum(area) FILTER (WHERE in_prev) AS a_prev
  FROM flag GROUP BY obj_type, city_id, obj_key
),
hrows AS (
  SELECT city_id, obj_key, 'cur' AS kind, u, band_lo, price_yuan, area FROM flag WHERE obj_type = 'HOUSE' AND in_cur
  UNION ALL
  SELECT city_id, obj_key, 'prev', u, band_lo, price_yuan, area FROM flag WHERE obj_type = 'HOUSE' AND in_prev
),
hn AS (SELECT *, count(*) OVER (PARTITION BY city_id, obj_key, kind) AS n FROM hrows),
{main}
mm AS (
  SELECT *, min(u) OVER g AS mn, (max(u) OVER g - min(u) OVER g) // 3 AS pitch
  FROM main WINDOW g AS (PARTITION BY city_id, obj_key, kind)
),
bk AS (
  SELECT *, CASE WHEN pitch = 0 THEN CASE WHEN u = mn THEN 0 ELSE 2147483647 END
                 ELSE CAST(ceil(CAST(u - mn AS DOUBLE) / pitch) AS BIGINT) END AS bucket
  FROM mm
),
bc AS (SELECT city_id, obj_key, kind, bucket, count(*) AS nb, sum(u) AS su FROM bk GROUP BY ALL),
tops AS (SELECT city_id, obj_key, kind, max(nb) AS top_n FROM bc GROUP BY ALL),
modes AS (
  SELECT bc.city_id, bc.obj_key, bc.kind, count(*) AS ties, max(su // nb) AS mode_u
  FROM bc JOIN tops USING (city_id, obj_key, kind) WHERE bc.nb = tops.top_n GROUP BY ALL
),
avgm AS (
  SELECT city_id, obj_key, kind, CAST(sum(price_yuan) AS DOUBLE) / NULLIF(CAST(sum(area) AS DOUBLE), 0) AS avg_p
  FROM main GROUP BY ALL
),
avgw AS (
  SELECT city_id, obj_key, kind, CAST(sum(price_yuan) AS DOUBLE) / NULLIF(CAST(sum(area) AS DOUBLE), 0) AS avg_w
  FROM hn WHERE n > 3 GROUP BY ALL
),
hp AS (
  SELECT a.city_id, a.obj_key, a.kind,
         CASE WHEN m.ties <> 1 THEN a.avg_p
              WHEN abs((CAST(m.mode_u AS DOUBLE) - w.avg_w) / NULLIF(CAST(m.mode_u AS DOUBLE), 0)) <= 0.2
              THEN CAST(m.mode_u AS DOUBLE) ELSE w.avg_w END AS price
  FROM avgm a JOIN modes m USING (city_id, obj_key, kind) JOIN avgw w USING (city_id, obj_key, kind)
),
fin AS (
  SELECT agg.*, {_label('agg.obj_type', 'agg.city_id', 'agg.obj_key')} AS obj_value,
         CASE WHEN agg.obj_type = 'HOUSE' AND n_cur > 3 THEN hc.price
              ELSE CAST(y_cur AS DOUBLE) / NULLIF(CAST(a_cur AS DOUBLE), 0) END AS p_cur,
         CASE WHEN n_prev > 0 THEN
              CASE WHEN agg.obj_type = 'HOUSE' AND n_prev > 3 THEN hv.price
                   ELSE CAST(y_prev AS DOUBLE) / NULLIF(CAST(a_prev AS DOUBLE), 0) END END AS p_prev,
         CAST(n_cur AS DOUBLE) AS q_cur, CASE WHEN n_prev > 0 THEN CAST(n_prev AS DOUBLE) END AS q_prev
  FROM agg
  LEFT JOIN hp hc ON agg.obj_type = 'HOUSE' AND hc.city_id = agg.city_id AND hc.obj_key = agg.obj_key AND hc.kind = 'cur'
  LEFT JOIN hp hv ON agg.obj_type = 'HOUSE' AND hv.city_id = agg.city_id AND hv.obj_key = agg.obj_key AND hv.kind = 'prev'
),
metrics AS (
  SELECT 'SECOND' AS dim, 'QUOTED_PRICE_AVG' AS "index", obj_type, obj_value, 'Period' AS period_type,
         period AS period_value, p_cur AS current_result, p_prev AS previous_result,
         (p_cur - p_prev) * 100.0 / NULLIF(p_prev, 0) AS mom
  FROM fin WHERE p_cur IS NOT NULL
  UNION ALL
  SELECT 'SECOND', 'QUOTED_VOLUME', obj_type, obj_value, 'Period', period, q_cur, q_prev,
         (q_cur - q_prev) * 100.0 / NULLIF(q_prev, 0)
  FROM fin
)
SELECT dim, "index", obj_type, obj_value, period_type, period_value,
       {_r('current_result')} AS current_result, {_r('previous_result')} AS previous_result,
       {_r('mom')} AS mom, CAST(NULL AS DOUBLE) AS yoy
FROM metrics"""


def metrics_all_sql() -> str:
    return f"SELECT * FROM ({deal_metrics_sql()}) d\nUNION ALL\nSELECT * FROM ({listing_metrics_sql()}) l"


def delimited_sql() -> str:
    return f"""
SELECT * REPLACE (CASE obj_type WHEN 'CITY' THEN obj_value || ':"q"\\path' WHEN 'DISTRICT' THEN '' ELSE obj_value END AS obj_value)
FROM ({metrics_all_sql()}) q"""


def text_table_sql() -> str:
    return f"""
SELECT * REPLACE (
         CASE obj_type WHEN 'CITY' THEN obj_value || ':"q"\\path' WHEN 'DISTRICT' THEN '' ELSE obj_value END AS obj_value,
         CASE obj_type WHEN 'PLATE' THEN '\\' ELSE period_value END AS period_value),
       {DS} AS ds
FROM ({deal_metrics_sql()}) q"""


def area_band_histogram_sql() -> str:
    return f"""
WITH {ADAPTERS}, {BANDS},
{LISTING_CLEAN.format(segment="TRUE")}
SELECT c.city_id, c.band_lo, count(*) AS listings, max(b.b_hi) AS band_hi
FROM clean c JOIN bands b ON c.band_lo = b.b_lo
GROUP BY c.city_id, c.band_lo"""


def month_bounds_sql() -> str:
    return """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT day, strftime(day, '%Y-%m') AS period,
       CAST(date_trunc('month', day) AS DATE) AS s, CAST(last_day(day) AS DATE) AS e,
       CAST(date_trunc('month', day) - INTERVAL 1 MONTH AS DATE) AS p_s,
       CAST(last_day(day) - INTERVAL 1 MONTH AS DATE) AS p_e,
       CAST(last_day(CAST(day - INTERVAL 1 MONTH AS DATE)) AS DATE) AS p_e_calendar
FROM d"""


def cyclical_period_of_date_sql() -> str:
    return f"""
WITH {ADAPTERS.split('periods(')[0]}periods(pname, lo, hi, s_off, ps_off, pe_off) AS (
  VALUES ('Yesterday', 1, 1, 1, 2, 2), ('SevenDays', 2, 7, 7, 14, 8), ('ThirtyDays', 8, 30, 30, 60, 31),
         ('SixtyDays', 31, 60, 60, 120, 61), ('NinetyDays', 61, 90, 90, 180, 91),
         ('SixMonths', 91, 180, 180, 360, 181), ('OneYear', 181, 360, 360, 720, 361)
),
d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT d.day, p.pname AS period,
       CASE WHEN p.pname IS NOT NULL THEN {AS_OF} - p.s_off END AS s,
       CASE WHEN p.pname IS NOT NULL THEN {AS_OF} - 1 END AS e,
       CASE WHEN p.pname IS NOT NULL THEN {AS_OF} - p.ps_off END AS p_s,
       CASE WHEN p.pname IS NOT NULL THEN {AS_OF} - p.pe_off END AS p_e
FROM d LEFT JOIN periods p ON date_diff('day', d.day, {AS_OF}) BETWEEN p.lo AND p.hi"""


def word_count_sql() -> str:
    return r"""
WITH docs AS (
  SELECT regexp_replace(text, '(\r\n|\r|\n)\z', '') AS body FROM documents WHERE text IS NOT NULL AND text <> ''
),
lines AS (SELECT unnest(regexp_split_to_array(body, '\r\n|\r|\n')) AS line FROM docs),
toks AS (
  SELECT CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN CAST([] AS VARCHAR[])
              ELSE string_split(rtrim(line, ' '), ' ') END AS arr
  FROM lines
)
SELECT word, count(*) AS "count" FROM (SELECT unnest(arr) AS word FROM toks) t GROUP BY word"""


def typed_csv_sql() -> str:
    return """
SELECT c_name AS name,
       CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE CAST(c_custkey % 90 + 10 AS INTEGER) END AS age,
       CASE WHEN c_custkey % 50 = 0 THEN c_name END AS _corrupt_record
FROM customer"""
