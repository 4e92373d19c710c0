"""The AQI rules on random inputs against a small model of their specification."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from airlake.functions import aqi, prominent, sub_index_count
from airlake.schemas import PROMINENT_LABELS

COLS = ["pm25", "pm10", "so2", "no2", "nh3", "co", "o3"]
reading = st.one_of(st.none(), st.integers(min_value=-3, max_value=6))   # small range: many ties


def model(vals):
    filled = [0 if v is None else v for v in vals]
    top = max(filled)
    label = PROMINENT_LABELS[filled.index(top)]                    # first of the largest
    pm = 1 if any(v is not None and v > 0 for v in vals[:2]) else 0
    gases = min(2, len([v for v in vals[2:] if v is not None and v != 0]))
    count = pm + gases
    present = [v for v in vals if v is not None]
    return label, count, (max(present) if count > 2 else 0)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[reading] * 7), min_size=20, max_size=60))
def test_rules_match_model(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c} bigint" for c in COLS))
    got = df.select(prominent(*COLS).alias("p"), sub_index_count(*COLS).alias("n"), aqi(*COLS).alias("a")).collect()
    assert [(r.p, r.n, r.a) for r in got] == [model(list(v)) for v in rows]


text_reading = st.one_of(
    st.none(), st.just("NA"),
    st.integers(min_value=-500, max_value=500).map(str),
    st.tuples(st.integers(min_value=-500, max_value=500), st.integers(min_value=0, max_value=999))
      .map(lambda t: f"{'-' if t[0] < 0 else ''}{abs(t[0])}.{t[1]:03d}"),
    st.integers(min_value=-50, max_value=50).map(lambda i: f"{i}.5"),          # exact ties
)


def clean_model(text):
    from decimal import ROUND_HALF_UP, Decimal
    if text is None or text == "NA":
        return 0
    return int(Decimal(text).quantize(Decimal(1), rounding=ROUND_HALF_UP))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(text_reading, min_size=20, max_size=60))
def test_clean_up_matches_model(spark, texts):
    from airlake.functions import na_to_zero
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r[0] for r in df.select(na_to_zero("v")).collect()] == [clean_model(t) for t in texts]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["s1", "s2", "s3"]),
                          st.sampled_from(["PM2.5", "PM10", "SO2", "NO2", "NH3", "CO", "OZONE", "XX"]),
                          st.one_of(st.none(), st.text(alphabet="0123456789.NAé-", max_size=5))),
                min_size=1, max_size=80))
def test_text_pivot_matches_model(spark, rows):
    from airlake.operators import pivot_max
    from airlake.schemas import POLLUTANT_COLUMNS
    df = spark.createDataFrame(rows, "k string, p string, v string")
    got = {r.k: tuple(r[c] for c in POLLUTANT_COLUMNS.values())
           for r in pivot_max(df, ["k"], "p", "v", POLLUTANT_COLUMNS).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        vals = []
        for pid in POLLUTANT_COLUMNS:
            xs = [v for kk, p, v in rows if kk == k and p == pid and v is not None]
            vals.append(max(xs) if xs else None)
        want[k] = tuple(vals)
    assert got == want
