"""Column functions: lenient casts, dollar stripping, date truncation, cleaning."""

import datetime as dt
import random
import re


from tillroll.functions import casts, cleaning, dates


def _strings(n=3000, seed=7):
    rng = random.Random(seed)
    alphabet = "0123456789+-.eE $dfxNaInity"
    fixed = [
        "", " ", "1", "+1", "-1", "1.", ".5", "1.5", "1e5", "1E-5", "1.5e+3", "e5", ".", "+", "-",
        "1.5d", "1.5f", "NaN", "Infinity", "-Infinity", " 1", "1 ", "12.5", "0012", "B07X",
        "$1.50", "1..5", "1e", "1e+", "--1", "0x10", "511111519874", "99999999999999999999",
    ]
    out = list(fixed)
    for _ in range(n):
        out.append("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 7))))
    return out


def test_lenient_double_matches_pattern(spark):
    values = _strings()
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = {r.s: r.d for r in df.select("s", casts.lenient_double("s", strip_dollar=False).alias("d")).collect()}
    pat = re.compile(casts.DECIMAL_PATTERN)
    for v in values:
        if pat.match(v):
            assert got[v] == float(v), v
        else:
            assert got[v] is None, (v, got[v])


def test_lenient_bigint_matches_pattern(spark):
    values = _strings(seed=11)
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = {r.s: r.n for r in df.select("s", casts.lenient_bigint("s").alias("n")).collect()}
    pat = re.compile(casts.INTEGER_PATTERN)
    for v in values:
        if pat.match(v) and -(2**63) <= int(v) < 2**63:
            assert got[v] == int(v), v
        else:
            assert got[v] is None, (v, got[v])


def test_strip_dollar_then_parse(spark):
    df = spark.createDataFrame([("$1.50",), ("1.50",), ("",), ("abc",), ("1.5d",), (None,), ("$$1",)], "s string")
    got = [r.d for r in df.select(casts.lenient_double("s").alias("d")).collect()]
    assert got == [1.5, 1.5, None, None, None, None, None]
    literal = [r.d for r in df.select(casts.lenient_double("s", strip_dollar=False).alias("d")).collect()]
    assert literal == [None, 1.5, None, None, None, None, None]


def test_barcodes(spark):
    df = spark.createDataFrame([("511111519874",), ("0012",), ("B07X",), ("12.5",)], "s string")
    assert [r.n for r in df.select(casts.lenient_bigint("s").alias("n")).collect()] == [511111519874, 12, None, None]


def test_epoch_millis_and_truncation(spark):
    df = spark.createDataFrame([(1614556799999,), (1614556800000,), (None,)], "ms bigint")
    out = df.select(
        dates.epoch_millis_to_ts("ms").alias("ts"),
        dates.month_start(dates.epoch_millis_to_ts("ms")).alias("m"),
        dates.hour_start(dates.epoch_millis_to_ts("ms")).alias("h"),
    )
    assert dict(out.dtypes) == {"ts": "timestamp_ntz", "m": "timestamp_ntz", "h": "timestamp_ntz"}
    rows = out.collect()
    assert rows[0].ts == dt.datetime(2021, 2, 28, 23, 59, 59, 999000)
    assert rows[0].m == dt.datetime(2021, 2, 1)
    assert rows[1].ts == dt.datetime(2021, 3, 1)
    assert rows[1].m == dt.datetime(2021, 3, 1)
    assert rows[2].ts is None and rows[2].m is None
    back = df.select(dates.ts_to_epoch_millis(dates.epoch_millis_to_ts("ms")).alias("ms")).collect()
    assert [r.ms for r in back] == [1614556799999, 1614556800000, None]


def test_minus_months_keeps_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 2, 1),)], "t timestamp_ntz")
    out = df.select(dates.minus_months("t", 6).alias("x"))
    assert out.dtypes == [("x", "timestamp_ntz")]
    assert out.first().x == dt.datetime(2020, 8, 1)


def test_ts_literal_rejects_month_day_year(spark):
    import pytest

    with pytest.raises(ValueError):
        dates.ts_literal("02-01-2021")
    df = spark.range(1).select(dates.ts_literal("2021-02-01").alias("t"))
    assert df.first().t == dt.datetime(2021, 2, 1)


def test_clean_quantity_and_price(spark):
    rows = [
        (3, 4, 2.0, "9.99"),  # both present: purchased wins
        (None, 4, None, "9.99"),  # fallbacks
        (None, None, None, "abc"),  # nothing usable
        (5, None, None, None),
    ]
    df = spark.createDataFrame(
        rows, "quantity_purchased bigint, user_flagged_quantity bigint, final_price double, user_flagged_price string"
    )
    out = df.select(
        cleaning.clean_quantity().alias("q"),
        cleaning.clean_price().alias("p"),
        cleaning.spend(cleaning.clean_quantity(), cleaning.clean_price()).alias("s"),
    ).collect()
    assert [(r.q, r.p, r.s) for r in out] == [(3, 2.0, 6.0), (4, 9.99, 4 * 9.99), (None, None, None), (5, None, None)]


def test_blank_description_and_mismatch(spark):
    df = spark.createDataFrame(
        [("ITEM NOT FOUND", 1, 1), ("  ", 1, 2), (None, None, 2), ("Milk", 2, None), ("", 3, 3)],
        "d string, a bigint, b bigint",
    )
    out = df.select(
        cleaning.is_blank_description("d").alias("blank"),
        cleaning.both_present_and_different("a", "b").alias("diff"),
    ).collect()
    assert [r.blank for r in out] == [True, True, True, False, True]
    assert [r.diff for r in out] == [False, True, False, False, False]


def test_truncation_ignores_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    rows = [(dt.datetime(2021, 3, 14, 2, 30, 15),), (dt.datetime(2020, 12, 31, 23, 59, 59),)]
    try:
        results = []
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame(rows, "t timestamp_ntz")
            results.append(
                [
                    tuple(r)
                    for r in df.select(
                        dates.month_start("t"), dates.day_start("t"), dates.hour_start("t"),
                        dates.truncate("minute", "t"), dates.ts_to_epoch_millis("t"),
                        dates.epoch_millis_to_ts(dates.ts_to_epoch_millis("t")),
                    ).collect()
                ]
            )
        assert results[0] == results[1] == results[2]
        assert results[0][0][:4] == (
            dt.datetime(2021, 3, 1), dt.datetime(2021, 3, 14), dt.datetime(2021, 3, 14, 2), dt.datetime(2021, 3, 14, 2, 30)
        )
        assert results[0][0][5] == rows[0][0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_truncation_and_epoch_match_python(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    stamps = st.lists(
        st.datetimes(min_value=dt.datetime(1970, 1, 1), max_value=dt.datetime(2100, 1, 1)).map(
            lambda d: d.replace(microsecond=(d.microsecond // 1000) * 1000)
        ),
        min_size=1,
        max_size=25,
    )

    @settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
    @given(values=stamps)
    def check(values):
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        try:
            df = spark.createDataFrame([(v,) for v in values], "t timestamp_ntz")
            rows = df.select(
                "t",
                dates.month_start("t").alias("m"),
                dates.day_start("t").alias("d"),
                dates.hour_start("t").alias("h"),
                dates.ts_to_epoch_millis("t").alias("ms"),
                dates.epoch_millis_to_ts(dates.ts_to_epoch_millis("t")).alias("back"),
            ).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
        epoch = dt.datetime(1970, 1, 1)
        for r in rows:
            t = r.t
            assert r.m == t.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
            assert r.d == t.replace(hour=0, minute=0, second=0, microsecond=0)
            assert r.h == t.replace(minute=0, second=0, microsecond=0)
            assert r.ms == (t - epoch) // dt.timedelta(milliseconds=1)
            assert r.back == t

    check()
