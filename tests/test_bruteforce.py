"""Spark operators against a plain-Python, per-group restatement of the
metric rules on random small inputs (independent of the Spark code path)."""

import calendar
import datetime as dt
import math
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.deals import deal_metrics
from tallyhouse.operators.houseprice import house_price

AS_OF = dt.date(2018, 9, 22)
DS = "2018-09-21"
PERIODS = [("Yesterday", 1, 1, 2, 2), ("SevenDays", 7, 1, 14, 8), ("ThirtyDays", 30, 1, 60, 31),
           ("SixtyDays", 60, 1, 120, 61), ("NinetyDays", 90, 1, 180, 91), ("SixMonths", 180, 1, 360, 181),
           ("OneYear", 360, 1, 720, 361)]


def _cyc(latest):
    for name, s, e, ps, pe in PERIODS:
        d = lambda n: AS_OF - dt.timedelta(days=n)
        if d(s) <= latest <= d(e):
            return name, (d(s), d(e)), (d(ps), d(pe))
    return None


def _month(day):
    first = day.replace(day=1)
    last = day.replace(day=calendar.monthrange(day.year, day.month)[1])
    py, pm = (first.year, first.month - 1) if first.month > 1 else (first.year - 1, 12)
    p_first = dt.date(py, pm, 1)
    p_last = dt.date(py, pm, min(last.day, calendar.monthrange(py, pm)[1]))
    return day.strftime("%Y-%m"), (first, last), (p_first, p_last)


def _pct(c, p):
    return None if p in (None, 0) or c is None else (c - p) * 100.0 / p


def _ratio(a, b):
    return None if b == 0 else float(a) / float(b)


def python_deal_metrics(deals, dim, release):
    """deals: (city, house, day|None, total, eval, label, area); dim: (city, house, district, plate, seg)."""
    groups = defaultdict(list)
    for city, house, day, total, ev, label, area in deals:
        for c, h, district, plate, seg in dim:
            if (c, h) != (city, house) or seg not in (1, 2):
                continue
            second = seg == 2
            price = ev if second and label in ("2", "行情参考") else total
            row = (day, Decimal(price), Decimal(area))
            dname = "SECOND" if second else "NEW"
            for otype, key in (("CITY", None), ("DISTRICT", district), ("PLATE", plate), ("HOUSE", house)):
                groups[(dname, otype, city, key)].append(row)
    out = set()
    for (dname, otype, city, key), rows in groups.items():
        label = f"city:{city}" + ("" if otype == "CITY" else f",{otype.lower()}:{'null' if key is None else key}")
        out.add((dname, "TOTAL_DEAL_VOLUME", otype, label, "Total", "Total", float(len(rows)), None, None))
        days = [r[0] for r in rows if r[0] is not None]
        latest = max(days) if days else None
        cyc = _cyc(latest) if latest else None

        def within(w):
            return [r for r in rows if r[0] is not None and w[0] <= r[0] <= w[1]]

        if cyc:
            cur, prev = within(cyc[1]), within(cyc[2])
            if cur:
                pc = _ratio(sum(r[1] for r in cur), sum(r[2] for r in cur))
                pp = _ratio(sum(r[1] for r in prev), sum(r[2] for r in prev)) if prev else None
                if pc is not None:
                    out.add((dname, "DEAL_PRICE_AVG", otype, label, "Period", cyc[0], pc, pp, _pct(pc, pp)))
        if dname == "NEW":
            vol = cyc and ("Period", cyc)
        elif otype == "HOUSE":
            vol = latest and ("Month", _month(latest))
        else:
            rel = release.get(city)
            vol = rel and ("Month", _month(rel))
        if vol:
            ptype, (pname, cw, pw) = vol
            vc, vp = len(within(cw)), len(within(pw))
            if vc:
                out.add((dname, "DEAL_VOLUME", otype, label, ptype, pname, float(vc), float(vp) if vp else None,
                         _pct(float(vc), float(vp) if vp else None)))
    return out


def _round(row):
    return tuple(round(v, 6) if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deals_against_python(spark, seed):
    rnd = random.Random(seed)
    cities = ["1", "2", "3"]
    dim = []
    for i in range(12):
        city = rnd.choice(cities)
        district = rnd.choice([None, "a", "b"])
        plate = rnd.choice([None, "p1", "p2"])
        dim.append((city, f"h{i}", district, plate, rnd.choice([1, 2, 1, 2, None, 3])))
        if rnd.random() < 0.2:
            dim.append((city, f"h{i}", district, plate, 2 if dim[-1][4] == 1 else 1))
    deals = []
    for _ in range(300):
        c, h = rnd.choice(dim)[:2]
        day = None if rnd.random() < 0.03 else AS_OF - dt.timedelta(days=rnd.choice([rnd.randint(-3, 40), rnd.randint(0, 800)]))
        total = f"{rnd.randint(100, 900)}.{rnd.randint(0, 99):02d}"
        ev = f"{rnd.randint(100, 900)}.5"
        deals.append((c, h, day, total, ev, rnd.choice(["1", "2", "行情参考", "签约实价", None, "x"]), str(rnd.randint(1, 9))))
    release = {c: AS_OF - dt.timedelta(days=rnd.randint(0, 400)) for c in cities if rnd.random() < 0.8}
    dim_df = spark.createDataFrame(
        [(c, h, d, (f"x@{p}" if p else "p"), s) for c, h, d, p, s in dim],
        "biz_city_id string, biz_house_id string, biz_district_id string, plate_fk string, is_first int",
    )
    deal_df = spark.createDataFrame(
        [(c, h, day.isoformat() if day else None, t, e, lab, a, DS) for c, h, day, t, e, lab, a in deals],
        "city_id string, house_id string, bargaindate string, totalprice string, eval_totalprice string, "
        "price_label string, bargain_area string, ds string",
    )
    rel_df = spark.createDataFrame([(int(c), None, d) for c, d in release.items()],
                                   "city_id long, new_updated date, second_updated date")
    got = {_round(tuple(r)[:9]) for r in deal_metrics(deal_df, dim_df, rel_df, DS, AS_OF).collect()}
    dim_py = [(c, h, d, p, s) for c, h, d, p, s in dim]
    want = {_round(r) for r in python_deal_metrics(deals, dim_py, release)}
    assert got == want


def python_mode(units, segment=3):
    lo, hi = min(units), max(units)
    pitch = (hi - lo) // segment
    buckets = defaultdict(list)
    for u in units:
        x = (u - lo) / pitch if pitch else (math.nan if u == lo else math.inf)
        b = 0 if math.isnan(x) else (2**31 - 1 if math.isinf(x) else math.ceil(x))
        buckets[b].append(u)
    sizes = sorted((len(v) for v in buckets.values()), reverse=True)
    if len(sizes) > 1 and sizes[0] == sizes[1]:
        return None
    top = max(buckets.values(), key=len)
    return sum(top) // len(top)


def test_histogram_mode_against_python(spark):
    rnd = random.Random(7)
    groups = {}
    for g in range(60):
        base = rnd.randint(1000, 50000)
        groups[f"g{g}"] = [base + rnd.choice([0, 0, 1, 5, rnd.randint(0, 3000)]) for _ in range(rnd.randint(4, 30))]
    rows = [(k, 90, u, 1, float(u), 1.0) for k, us in groups.items() for u in us]
    df = spark.createDataFrame(rows, "k string, band_lo int, u long, cnt long, sp double, sa double")
    grain = df.groupBy("k", "band_lo", "u").agg(F.sum("cnt").alias("cnt"), F.sum("sp").alias("sp"), F.sum("sa").alias("sa"))
    got = {r.k: r.mode for r in house_price(grain, ["k"]).collect()}
    for k, us in groups.items():
        m = python_mode(us)
        assert got[k] == (None if m is None else float(m)), (k, sorted(us))


# ---------------------------------------------------------------- listings

def python_house_price(rows):
    """rows: (cents int, area int, area_dec Decimal); robust price with all
    rows as the main rows."""
    if len(rows) <= 3:
        return _ratio(sum(Decimal(c) / 100 for c, _, _ in rows), sum(a for _, _, a in rows))
    avg = _ratio(sum(Decimal(c) / 100 for c, _, _ in rows), sum(a for _, _, a in rows))
    mode = python_mode([(c // 100) // ai for c, ai, _ in rows])
    if mode is None or mode == 0 or abs((mode - avg) / mode) > 0.2:
        return avg
    return float(mode)


def python_listing_metrics(listings, dim):
    """listings: (city, house, first 'yyyy-mm-dd[ hh:mm:ss]', last|None, area str, cents str,
    valuation str|None, floors str, status str); dim: (city, house, district, plate, seg)."""
    groups = defaultdict(list)
    for city, house, first, last, area, cents, val, floors, status in listings:
        a, c = float(area), float(cents)
        v = None if val is None else float(val)
        try:
            fd = dt.date.fromisoformat(first.split(" ")[0])
        except ValueError:
            continue
        if not (status in ("3", "5", "7") and math.floor(float(floors)) < 1000 and 0 < math.floor(a) < 1000
                and 100000 <= c / a <= 50000000 and v is not None and v / c <= 2 and fd < AS_OF):
            continue
        if last is None:
            end = fd
        else:
            ld = dt.date.fromisoformat(last[:10])
            end = AS_OF - dt.timedelta(days=1) if ld >= AS_OF else ld
        row = (fd, end, int(cents), math.floor(a), Decimal(area))
        for c2, h2, district, plate, _ in dim:  # every row, whatever its segment code
            if (c2, h2) == (city, house):
                for otype, key in (("CITY", None), ("DISTRICT", district), ("HOUSE", house)):
                    groups[(otype, city, key)].append(row)
    out = set()
    for (otype, city, key), rows in groups.items():
        label = f"city:{city}" + ("" if otype == "CITY" else f",{otype.lower()}:{'null' if key is None else key}")
        cyc = _cyc(max(r[1] for r in rows))
        if not cyc:
            continue
        name, (s, e), (ps, pe) = cyc
        cur = [r for r in rows if r[0] <= e and r[1] >= s]
        prev = [r for r in rows if r[0] <= ps and r[1] >= pe]

        def price(rs):
            if otype == "HOUSE":
                return python_house_price([(r[2], r[3], r[4]) for r in rs])
            return _ratio(sum(Decimal(r[2]) / 100 for r in rs), sum(r[4] for r in rs))

        pc = price(cur) if cur else None
        pp = price(prev) if prev else None
        if pc is not None:
            out.add(("SECOND", "QUOTED_PRICE_AVG", otype, label, "Period", name, pc, pp, _pct(pc, pp)))
        qc, qp = float(len(cur)), (float(len(prev)) if prev else None)
        out.add(("SECOND", "QUOTED_VOLUME", otype, label, "Period", name, qc, qp, _pct(qc, qp)))
    return out


@pytest.mark.parametrize("seed", [11, 12])
def test_listings_against_python(spark, seed):
    from tallyhouse.operators.listings import listing_metrics

    rnd = random.Random(seed)
    dim = []
    for i in range(6):
        city = rnd.choice(["1", "2"])
        dim.append((city, f"h{i}", rnd.choice([None, "a"]), rnd.choice([None, "p1"]), rnd.choice([1, 2, None, 3])))
        if rnd.random() < 0.3:
            dim.append((city, f"h{i}", dim[-1][2], dim[-1][3], rnd.choice([1, 2, None])))
    listings = []
    for _ in range(250):
        c, h = rnd.choice(dim)[:2]
        first = AS_OF - dt.timedelta(days=rnd.choice([rnd.randint(1, 30), rnd.randint(1, 900)]))
        last = None if rnd.random() < 0.15 else first + dt.timedelta(days=rnd.randint(0, 120))
        area = rnd.randint(20, 400)
        unit = rnd.choice([rnd.randint(1500000, 1600000), rnd.randint(1000000, 3000000), 50000])
        cents = area * unit + rnd.randint(0, 99)
        val = None if rnd.random() < 0.05 else str(cents * rnd.choice([1, 1.5, 2.5]))
        listings.append((
            c, h, first.isoformat() + rnd.choice(["", "", "", " 10:00:00", "99", "garbage"]),
            None if last is None else last.isoformat(), str(area), str(cents), val,
            str(rnd.choice([10, 20, 1200])), rnd.choice(["3", "5", "7", "1"]),
        ))
    dim_df = spark.createDataFrame(
        [(c, h, d, (f"x@{p}" if p else "p"), s) for c, h, d, p, s in dim],
        "biz_city_id string, biz_house_id string, biz_district_id string, plate_fk string, is_first int",
    )
    lst_df = spark.createDataFrame(
        [(*row, DS) for row in listings],
        "city_id string, house_id string, first_pub_date string, last_pub_date string, area string, "
        "quoted_price string, evaluation_high_price string, total_floors string, status string, ds string",
    )
    got = {_round(tuple(r)[:9]) for r in listing_metrics(lst_df, dim_df, DS, AS_OF).collect()}
    want = {_round(r) for r in python_listing_metrics(listings, dim)}
    assert got == want
