import datetime as dt
import random
import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillstar.functions import (
    clock_text, digits_only, mean_micros, nullable_text, parse_date, sale_moment, split_clock,
    strict_double, to_kg, to_micros, to_smallint, uuid_text, varchar, weight_class,
)


def test_weights(values):
    cases = {
        "1.6kg": 1.6, "590g": 0.59, "5 x 15g": 0.075, "800ml": 0.8, "16oz": 16 * 0.0283495,
        "77g .": 0.077, ".5g .": 0.005, "gk1.5kg": 1.5, "1e3g": 1.0, "16 oz": 16 * 0.0283495,
        "5x15g": None, "3 x 2oz": None, "2 x 1kg": None, "8 x 85ml": None, "g": None, "1KG": None,
        "JUNK": None, "": None, "12.5fg": None, "1_0g": None, None: None,
    }
    got = values(to_kg, cases)
    for (text, want), kg in zip(cases.items(), got):
        assert kg == want, text


def by_class(text):
    """Kilograms by the rule of each class on its own; None where no class can read it."""
    def number(t):
        return float(t) if re.fullmatch(r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*", t, re.ASCII) else None

    found = []
    if text.endswith("kg"):
        found.append(number(text.strip("kg")))
    if text.endswith("g") and not text.endswith("kg") and "x" not in text:
        found.append(number(text.strip("g")) and number(text.strip("g")) / 1000)
    if "x" in text:
        parts = [number(p) for p in text.strip("g").split(" ")] + [None] * 3
        found.append(None if None in (parts[0], parts[2]) else parts[0] * parts[2] / 1000)
    for unit, factor, divisor in [("ml", 1, 1000), ("oz", 0.0283495, 1), ("g .", 1, 1000)]:
        if text.endswith(unit):
            amount = number(text.strip(unit))
            found.append(None if amount is None else amount * factor / divisor)
    return None if None in found or not found else found[0]


def test_one_expression_equals_the_classes(values):
    """Wherever every class that claims a text can read it, the one expression agrees."""
    rng = random.Random(2)
    pieces = ["1", "2.5", ".5", "30", "x", " x ", " ", "k", "g", "kg", "ml", "oz", "g .", ".", "m"]
    texts = {"".join(rng.choices(pieces, k=rng.randrange(1, 7))) for _ in range(4000)}
    texts |= {f"{rng.choice(pieces[:4])}{rng.choice(['', ' '])}{rng.choice(pieces[8:13])}" for _ in range(200)}
    texts |= {f"{rng.randrange(9)} x {rng.randrange(99)}{rng.choice(pieces[6:])}" for _ in range(300)}
    texts = sorted(texts)
    got = values(to_kg, texts)
    assert sum(kg is not None for kg in got) > 100
    for text, kg in zip(texts, got):
        assert kg == by_class(text), text


def test_weight_class(spark):
    kgs = [1.999, 2.0, 39.9, 40.0, 139.9, 140.0, None]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(kgs)], "i int, k double")
    got = [r.c for r in df.select("i", weight_class(F.col("k")).alias("c")).orderBy("i").collect()]
    assert got == ["Light", "Mid_Sized", "Mid_Sized", "Heavy", "Heavy", "Truck_Required", None]


def test_strict_numbers(values):
    cases = {
        "12.5": 12.5, " 7 ": 7.0, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "-2": -2.0, "+3": 3.0, "\t4\n": 4.0,
        "12.5f": None, "3D": None, "1_0": None, "abc": None, "": None, ".": None, "inf": None,
        "nan": None, "1e": None, None: None,
    }
    assert values(strict_double, cases) == list(cases.values())


def test_digits_only(values):
    cases = {"J78": 78, "30e": 30, "-12.5e": 125, "": None, "JUNK": None, None: None}
    assert values(digits_only, cases) == list(cases.values())


def test_dates(values):
    d = dt.date
    cases = {
        "1968-10-16": d(1968, 10, 16), "1968 October 16": d(1968, 10, 16),
        "October 2000 05": d(2000, 10, 5), "October 2000 5": d(2000, 10, 5),
        "2006/09/03": d(2006, 9, 3), "2006/9/3": d(2006, 9, 3), "01/02/2003": d(2003, 1, 2),
        "13/02/2003": d(2003, 2, 13), "20030213": d(2003, 2, 13),
        "2003-02-13 10:11:12": d(2003, 2, 13), "Feb 2003 13": d(2003, 2, 13),
        "2003 Feb 13": d(2003, 2, 13), "2003 May 1": d(2003, 5, 1), "13 February 2003": d(2003, 2, 13),
        "13 Feb 2003": d(2003, 2, 13), "February 13, 2003": d(2003, 2, 13),
        "feb 13, 2003": d(2003, 2, 13), "  1968-10-16 ": d(1968, 10, 16), "2020-02-29": d(2020, 2, 29),
        "NULL": None, "": None, "October 2000": None, "2020-02-30": None, "10/11/12": None,
        "Octember 2000 05": None, "31/31/2003": None, None: None,
    }
    got = values(parse_date, cases)
    for (text, want), value in zip(cases.items(), got):
        assert value == want, text


def test_strict_date_raises(values):
    assert values(lambda c: parse_date(c, strict=True), ["2001-02-03"]) == [dt.date(2001, 2, 3)]
    for bad in ["JUNK", None]:
        with pytest.raises(PySparkException, match="unreadable date"):
            values(lambda c: parse_date(c, strict=True), [bad])


def test_uuid(values):
    plain = "93caf182-e4e9-4c6e-bebb-60a1a9dcf9b8"
    cases = {
        plain: plain, plain.upper(): plain, plain.replace("-", ""): plain, "{" + plain + "}": plain,
        "JUNK": None, plain[:-1]: None, plain.replace("9", "g"): None, "": None, None: None,
    }
    assert values(uuid_text, cases) == list(cases.values())


def test_varchar_and_null_marks(values):
    assert values(lambda c: varchar(c, 3), ["abcd", "ab", None]) == ["abc", "ab", None]
    assert values(lambda c: varchar(c), ["abcd"]) == ["abcd"]
    assert values(lambda c: nullable_text(c, "N/A"), ["N/A", "", "1", None]) == [None, None, "1", None]


def test_smallint(values):
    small = lambda c: to_smallint(c.cast("bigint"))
    assert values(small, ["32767", "32768", None]) == [32767, None, None]
    with pytest.raises(PySparkException):
        values(lambda c: to_smallint(c.cast("bigint"), strict=True), ["32768"])


def test_sale_moment(spark):
    rows = [
        (0, "2012", "9", "3", "2:0:6.5"), (1, "2012", "09", "03", "22:00:06"),
        (2, None, "9", "3", "2:0:6"), (3, "2012", "13", "3", "2:0:6"), (4, "1969", "12", "31", "23:59:59"),
    ]
    df = spark.createDataFrame(rows, "i int, y string, m string, d string, t string")
    moment = sale_moment(*(F.col(c) for c in "ymdt"))
    got = df.select("i", moment.alias("ts"), to_micros(moment).alias("us")).orderBy("i").collect()
    assert [r.ts for r in got] == [
        dt.datetime(2012, 9, 3, 2, 0, 6, 500000), dt.datetime(2012, 9, 3, 22, 0, 6), None, None,
        dt.datetime(1969, 12, 31, 23, 59, 59),
    ]
    epoch = dt.datetime(1970, 1, 1)
    want = [None if r.ts is None else (r.ts - epoch) // dt.timedelta(microseconds=1) for r in got]
    assert [r.us for r in got] == want


def test_micros_ignore_the_session_zone(spark):
    """A clock time that daylight saving skips still counts as written."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2012-03-25 01:30:00' AS ts")
        assert df.select(to_micros(F.col("ts"))).first()[0] == 1_332_639_000_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clock_text(spark):
    df = spark.createDataFrame([(0, 8_000_123_999), (1, 400 * 3_600_000_000), (2, None)], "i int, us bigint")
    text = clock_text(F.col("us"))
    got = df.select("i", text.alias("t"), split_clock(text).alias("p")).orderBy("i").collect()
    assert [r.t for r in got] == ["02:13:20.123", "400:00:00.000", None]
    assert got[0].p.asDict() == {"h": "02", "m": "13", "s": "20", "ms": "123"}


def test_mean_micros(spark):
    df = spark.createDataFrame([(0, 10, 4), (1, 9, 4), (2, 0, 3), (3, 5, 0)], "i int, t bigint, n bigint")
    got = df.select("i", mean_micros(F.col("t"), F.col("n")).alias("m")).orderBy("i").collect()
    assert [r.m for r in got] == [3, 2, 0, None]


def public_date(text):
    """What the public date parser reads, None where it fills parts in from a default."""
    from dateutil import parser

    try:
        found = {parser.parse(text, default=dt.datetime(year, 2, 28)).date() for year in (1999, 2004)}
        found |= {parser.parse(text, default=dt.datetime(2004, 1, 1)).date()}
    except (parser.ParserError, OverflowError):
        return None
    return found.pop() if len(found) == 1 else None


def test_dates_agree_with_the_public_parser(values):
    """All orders of day, month and year, with names whole and cut, weekdays, clocks and separators."""
    rnd, texts = random.Random(11), []
    for _ in range(700):
        d = dt.date(rnd.randint(1700, 2250), rnd.randint(1, 12), rnd.randint(1, 28))
        month = rnd.choice([d.strftime("%B"), d.strftime("%b"), str(d.month), f"{d.month:02}"])
        parts = [month, rnd.choice([str(d.day), f"{d.day:02}", f"{d.day}th"]), str(d.year)]
        rnd.shuffle(parts)
        separator = rnd.choice([" ", "-", "/", ", ", ". ", "  "])
        text = separator.join(parts[: rnd.choice([3] * 9 + [2])])
        text = rnd.choice(["", "", "", d.strftime("%A "), d.strftime("%a, ")]) + text
        texts.append(text + rnd.choice(["", "", "", " 08:00", " 8:15:30 PM", "T08:00:00", "T08:00:00.25Z"]))
    got = values(parse_date, texts)
    assert dict(zip(texts, got, strict=True)) == {t: public_date(t) for t in texts}
    assert sum(d is not None for d in got) > 400
