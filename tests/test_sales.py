"""The sales questions against brute force on small skewed tables, both ways of joining."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest

from tillstar.plans import sales
from tillstar.plans.report import report


def make(seed):
    rng = random.Random(seed)
    stores = [
        (f"S{i}", rng.choice(["DE", "GB", "US"]), f"town{i % 9}", rng.choice(["Web Portal", "Local", None]),
         rng.choice([None, 1, 20, 300]))
        for i in range(25)
    ]
    products = [(f"P{i}", rng.choice([None, 0.1, 1.99, 19.95, 1000.0])) for i in range(38)]
    products += [("P38", 0.125), ("P39", 1e17)]
    dates = []
    for i in range(60):
        t = dt.datetime(rng.choice([2010, 2011, 2012]), rng.choice([1, 2, 10]), rng.randrange(1, 28),
                        rng.randrange(24), rng.randrange(60), rng.randrange(60))
        dates.append((f"d{i}", str(t.year), str(t.month), str(t.day), f"{t.hour}:{t.minute}:{t.second}"))
    dates.append(("alone", "1999", "5", "5", "1:2:3"))
    dates.append(("broken", "2010", "1", "99", "1:2:3"))
    orders = [
        (rng.choice(["d0", "d1"] + [d[0] for d in dates[:-2]] + ["lost"]) if i % 3 else "d5",
         "S0" if i % 3 == 1 else rng.choice([s[0] for s in stores] + ["lost", None]),
         "P0" if i % 4 == 0 else rng.choice([p[0] for p in products] + ["lost"]),
         rng.choice([1, 2, 5, None]))
        for i in range(600)
    ] + [("alone", "S1", "P1", 1), ("broken", "S1", "P1", 1)]
    return stores, products, dates, orders


@pytest.fixture(params=["broadcast", "shuffle", "mixed"])
def case(request, spark, monkeypatch, tmp_path):
    stores, products, dates, orders = make(11)
    tables = {
        "stores": spark.createDataFrame(
            stores, "store_code string, country_code string, locality string, store_type string, staff_numbers smallint"),
        "products": spark.createDataFrame(products, "product_code string, product_price double"),
        "dates": spark.createDataFrame(dates, "date_uuid string, year string, month string, day string, timestamp string"),
        "orders": spark.createDataFrame(
            orders, "date_uuid string, store_code string, product_code string, product_quantity smallint"),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    monkeypatch.setattr("tillstar.operators.joins.ROWS_PER_TASK", 20)
    if request.param == "mixed":  # prices do not fit, every other table does
        prices = lambda df: "unit_price" not in df.columns
        monkeypatch.setattr("tillstar.plans.sales.broadcastable", prices)
        monkeypatch.setattr("tillstar.operators.joins.broadcastable", prices)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield tables, stores, products, dates, orders
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def pence(x):
    return None if x is None else Decimal(repr(x)) * 100


def amounts(products, dates, orders):
    """(order, date row, pence) of every order with a known product and date; pence may be None."""
    price, date = dict(products), {d[0]: d for d in dates}
    for o in orders:
        if o[2] in price and o[0] in date:
            unit = pence(price[o[2]])
            yield o, date[o[0]], None if unit is None or o[3] is None else unit * o[3]


def add(totals, key, value):
    totals.setdefault(key, None)
    if value is not None:
        totals[key] = (totals[key] or 0) + value


def money(totals):
    return {k: None if v is None else float(v / 100) for k, v in totals.items()}


def test_store_questions(case):
    tables, stores, *_ = case
    countries = Counter(s[1] for s in stores)
    rows = sales.stores_per_country(tables).collect()
    assert {r.country_code: r.total_no_stores for r in rows} == countries
    assert [r.total_no_stores for r in rows] == sorted(countries.values(), reverse=True)

    towns = Counter(s[2] for s in stores)
    want = sorted(towns.items(), key=lambda x: (-x[1], x[0]))[:7]
    assert [tuple(r) for r in sales.top_localities(tables).collect()] == want

    staff: dict = {}
    for s in stores:
        add(staff, s[1], s[4])
    assert {r.country_code: r.total_staff_numbers for r in sales.staff_per_country(tables).collect()} == staff


def test_months(case):
    tables, _, products, dates, orders = case
    by_month, by_year_month = {}, {}
    for _, d, amount in amounts(products, dates, orders):
        add(by_month, d[2], amount)
        add(by_year_month, (d[1], d[2]), amount)
    rows = sales.sales_by_month(tables).collect()
    assert {r.month: r.total_sales for r in rows} == money(by_month)
    order = lambda kv: (kv[1] is not None, -(kv[1] or 0), kv[0])
    want = [(*k, v) for k, v in sorted(money(by_year_month).items(), key=order)[:10]]
    assert [(r.year, r.month, r.total_sales) for r in sales.top_year_months(tables).collect()] == want

    firsts = {}
    for o, d, _ in amounts(products, dates, orders):
        firsts[d[2]] = min(firsts.get(d[2], (o[2], o[0])), (o[2], o[0]))
    sample = sales.sales_by_month_first_sale(tables).collect()
    assert {r.month: (r.product_code, r.date_uuid) for r in sample} == firsts
    assert {r.month: r.total_sales for r in sample} == money(by_month)


def test_stores_and_channels(case):
    tables, stores, products, _, orders = case
    store, price = {s[0]: s for s in stores}, dict(products)
    by_type, german, moments, pieces = {}, {}, defaultdict(set), {}
    for o in orders:
        if o[1] not in store:
            continue
        s = store[o[1]]
        place = "Web" if s[3] == "Web Portal" else "Offline"
        moments[place].add(o[0])
        add(pieces, place, o[3])
        if o[2] in price:
            unit = pence(price[o[2]])
            amount = None if unit is None or o[3] is None else unit * o[3]
            add(by_type, s[3], amount)
            if s[1] == "DE":
                add(german, s[3], amount)
    rows = sales.web_vs_offline(tables).collect()
    assert [r.location for r in rows] == ["Web", "Offline"]
    assert {r.location: r.numbers_of_sales for r in rows} == {k: len(v) for k, v in moments.items()}
    assert {r.location: r.product_quantity_count for r in rows} == pieces

    share = sales.store_type_share(tables).collect()
    total = float(sum(v for v in by_type.values() if v) / 100)
    assert {r.store_type: r.total_sales for r in share} == money(by_type)
    for r in share:
        assert r.sales_percentage == pytest.approx(r.total_sales / total * 100)
    germans = sales.country_sales_by_store_type(tables).collect()
    assert {r.store_type: r.total_sales for r in germans} == money(german)


def test_gaps(case):
    tables, _, _, dates, orders = case
    sold = Counter(o[0] for o in orders)
    years = defaultdict(list)
    for key, y, m, d, clock in dates:
        if key != "broken":
            h, mi, s = map(int, clock.split(":"))
            years[int(y)] += [dt.datetime(int(y), int(m), int(d), h, mi, s)] * sold[key]
    want = {}
    for y, ts in years.items():
        ts.sort()
        gaps = [(b - a) // dt.timedelta(microseconds=1) for a, b in zip(ts, ts[1:])]
        if gaps:
            want[y] = (2 * sum(gaps) + len(gaps)) // (2 * len(gaps))
    assert 1999 not in want
    for question in (sales.sale_gap_by_year, sales.sale_gap_by_year_window):
        assert {r.sale_year: r.mean_gap_us for r in question(tables).collect()} == want
    rows = sales.sale_gap_formatted(tables).collect()
    texts = [r.actual_time_taken for r in rows]
    assert texts == sorted(texts, reverse=True) and len(rows) == min(5, len(want))
    for r in rows:
        assert f"{r.h}:{r.m}:{r.s}.{r.ms}" == r.actual_time_taken
        us = want[r.sale_year]
        assert (int(r.h) * 3600 + int(r.m) * 60 + int(r.s)) * 1000 + int(r.ms) == us // 1000


def test_plans(spark, plan_of):
    from tillstar.contract.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    assert "Window" not in plan_of(QUERIES["sale_gap_by_year"](spark, sf))
    for top in ("top_localities", "top_year_months", "sale_gap_formatted"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[top](spark, sf))
    for name, query in QUERIES.items():
        if name.startswith(("indexed_rows", "write_overwrite", "scan_", "star_", "skewed_", "listed", "profile_star", "source_", "broken_")):
            continue
        text = plan_of(query(spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "Python" not in text and "BatchEvalPython" not in text, name


def test_sample_sale_does_not_sort_the_fact(spark, plan_of):
    from tillstar.contract.queries import QUERIES

    text = plan_of(QUERIES["sales_by_month_first_sale"](spark, "/root/testdata/sf0.001"))
    # What is sorted for the sample are sales of the first products, met while the fact is
    # read: between its scan and the next sort or shuffle stands a semi join.
    lines = text.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "product_quantity" in line]
    next_up = [next(x for x in reversed(lines[:i]) if any(n in x for n in ("LeftSemi", "Sort", "hashpartitioning", "HashAggregate"))) for i in scans]
    assert any("LeftSemi" in line for line in next_up)
    # And nothing has run to make this plan.
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    QUERIES["sales_by_month_first_sale"](spark, "/root/testdata/sf0.001")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs


def test_first_products_are_found_once(spark, tmp_path, no_broadcast, plan_of):
    """Every use of the months shares the shuffles that they come from."""
    from tillstar.contract import fixtures as fx

    sf = "/root/testdata/sf0.001"
    tables = {"orders": fx.sales_fact(spark, sf), "products": fx.sales_products(spark, sf), "dates": fx.raw_dates(spark, sf)}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    found = sales.sales_by_month_first_sale(tables)
    assert len(found.collect()) == 12
    final = plan_of(found).split("== Initial Plan ==")[0]
    exchanged = [line for line in final.splitlines() if "Exchange hashpartitioning(month" in line and "product_code" in line.split("ENSURE")[0]]
    made = [line for line in exchanged if "ReusedExchange" not in line and "total_sales" not in line]
    assert len(made) == 1, exchanged


def test_date_keys_move_once(spark, tmp_path, no_broadcast, plan_of):
    """Where dates and prices are large, sales go on to the prices with a month for their date key."""
    from tillstar.contract import fixtures as fx

    sf = "/root/testdata/sf0.001"
    tables = {"orders": fx.sales_fact(spark, sf), "products": fx.sales_products(spark, sf), "dates": fx.raw_dates(spark, sf)}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    for question in (sales.sales_by_month, sales.top_year_months):
        initial = plan_of(question(tables)).split("== Initial Plan ==")[-1].splitlines()
        by_date = [line for line in initial if "Exchange hashpartitioning(date_uuid" in line]
        assert len(by_date) == 2, initial  # the fact's, once, and the dates'
        # No key of a date goes through the shuffle by product.
        lookups = [i for i, line in enumerate(initial) if "Join [product_code" in line]
        dates = [i for i, line in enumerate(initial) if "Join [date_uuid" in line]
        assert lookups and dates and min(dates) > max(lookups)


def test_report(spark):
    df = spark.createDataFrame([("a", 1234567.891, 3), ("b", 2.675, 4), ("c", None, 5)], "k string, x double, n int")
    got = [tuple(r) for r in report(df).orderBy("k").collect()]
    assert got == [("a", f"{1234567.891:.2f}", 3), ("b", f"{2.675:.2f}", 4), ("c", None, 5)]
