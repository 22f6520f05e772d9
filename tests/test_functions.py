"""Column helpers against plain-Python models (property-based, batched per job)."""

import re
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions.money import avg_half_up, half_up_div, share_pct_half_up
from tillroll.functions.text import INTEGER_TEXT, lenient_integer, lenient_us_timestamp

SETTINGS = settings(max_examples=8, deadline=None)

int_text = st.one_of(
    st.from_regex(r"\A ?[+-]?[0-9]{1,12}(\.[0-9]{0,3})? ?\Z", fullmatch=True),
    st.text(alphabet="0123456789.+-e ax", max_size=8),
)


def model_int(s, lo=-(2**31), hi=2**31 - 1):
    if s is None:
        return None
    m = re.match(INTEGER_TEXT, s.strip(" "))
    if not m:
        return None
    v = int(m.group(1))
    return v if lo <= v <= hi else None


@SETTINGS
@given(st.lists(st.one_of(st.none(), int_text), min_size=1, max_size=60))
def test_lenient_integer_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r["i"]: r["v"] for r in df.select("i", lenient_integer("s", "int").alias("v")).collect()}
    assert got == {i: model_int(v) for i, v in enumerate(values)}


date_parts = st.tuples(
    st.integers(0, 14), st.integers(0, 32), st.integers(1999, 2012), st.integers(0, 25), st.integers(0, 61)
)


def model_ts(m, d, y, h, mi):
    try:
        return datetime(y, m, d, h, mi)
    except ValueError:
        return None


@SETTINGS
@given(st.lists(date_parts, min_size=1, max_size=60))
def test_lenient_us_timestamp_matches_model(spark, parts):
    texts = [f"{m}/{d}/{y} {h}:{mi:02d}" for m, d, y, h, mi in parts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = {r["i"]: r["t"] for r in df.select("i", lenient_us_timestamp("s").alias("t")).collect()}
    assert got == {i: model_ts(*p) for i, p in enumerate(parts)}


def test_lenient_us_timestamp_rejects_other_shapes(spark):
    texts = ["15/5/2011 14:48", "1/11/2011 12:90", "2011-01-02 10:00", "1/2/11 10:00", "1/2/2011 10:5", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r[0] for r in df.select(lenient_us_timestamp("s")).collect()] == [None] * len(texts)


def half_up(q: Decimal) -> Decimal:
    return q.quantize(Decimal("1"), rounding=ROUND_HALF_UP)


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(-10**6, 10**6)), min_size=1, max_size=60))
def test_half_up_div_matches_decimal(spark, pairs):
    df = spark.createDataFrame(list(enumerate(pairs)), "i int, p struct<n:bigint,d:bigint>")
    out = df.select("i", half_up_div(F.col("p.n").cast("decimal(38,0)"), F.col("p.d").cast("decimal(38,0)")).alias("q"))
    got = {r["i"]: r["q"] for r in out.collect()}
    want = {i: (None if d == 0 else int(half_up(Decimal(n) / Decimal(d)))) for i, (n, d) in enumerate(pairs)}
    assert got == want


@SETTINGS
@given(st.lists(st.lists(st.integers(0, 99999), min_size=1, max_size=7), min_size=1, max_size=20))
def test_avg_half_up_matches_decimal(spark, groups):
    rows = [(g, Decimal(c) / 100) for g, cs in enumerate(groups) for c in cs]
    df = spark.createDataFrame(rows, "g int, p decimal(10,2)")
    got = {r["g"]: r["a"] for r in df.groupBy("g").agg(avg_half_up("p").alias("a")).collect()}
    want = {g: (sum(Decimal(c) for c in cs) / len(cs) / 100).quantize(Decimal("0.01"), ROUND_HALF_UP)
            for g, cs in enumerate(groups)}
    assert got == want


def test_share_pct_half_up(spark):
    df = spark.createDataFrame(
        [(Decimal("1.00"), Decimal("3.00")), (Decimal("2.00"), Decimal("3.00")), (Decimal("-1.00"), Decimal("8.00")),
         (Decimal("5.00"), Decimal("0.00"))],
        "r decimal(18,2), t decimal(18,2)",
    )
    got = [r[0] for r in df.select(share_pct_half_up(F.col("r"), F.col("t"))).collect()]
    assert got == [33.33, 66.67, -12.5, None]
