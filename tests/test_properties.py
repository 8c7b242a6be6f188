"""Property tests: Spark operators against independent Python computations on
generated inputs (SURVEY §5, layer 3)."""

from __future__ import annotations

import datetime as dt
import math
import re
from urllib.parse import urljoin

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsengine.functions import scalars as S
from obsengine.functions.urls import resolve_url
from obsengine.operators import aggregate as A
from obsengine.operators import clean as C

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

_NUM = re.compile(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")
_INF = re.compile(r"^\s*[+-]?(inf|infinity)\s*$", re.I)


def py_to_double(s):
    if s is None:
        return None
    if _NUM.match(s) or _INF.match(s):
        return float(s.strip())
    return None


number_text = st.one_of(
    st.floats(allow_nan=True, allow_infinity=True).map(repr),
    st.integers(-10**6, 10**6).map(str),
    st.sampled_from(["", " 2 ", "1.5d", "NaN", "nan", "-inf", "Infinity", "1e3", ".5", "5.", "1,5", "abc", "+7", "- 1"]),
    st.text(alphabet="0123456789.eE+- dfx", max_size=8),
)


@SETTINGS
@given(st.lists(number_text, min_size=1, max_size=40))
def test_to_double_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(S.to_double("v")).collect()]
    for v, g in zip(values, got):
        e = py_to_double(v)
        assert (g is None and e is None) or (g == e) or (math.isinf(e) and g == e), (v, g, e)


segment = st.sampled_from(["a", "b", "c1", ".", "..", "", "x.html", "index.html"])
path = st.lists(segment, max_size=6).map(lambda xs: "/".join(xs))
base = st.tuples(st.sampled_from(["http", "https"]), st.sampled_from(["h.ex", "m.h.ex:8080"]),
                 st.lists(st.sampled_from(["a", "b", "c", "d.html"]), max_size=4),
                 st.sampled_from(["", "?q=1", "#f", "?q=1#f"])).map(
    lambda t: f"{t[0]}://{t[1]}/" + "/".join(t[2]) + t[3])
href = st.one_of(path, path.map(lambda p: "/" + p), path.map(lambda p: p + "?z=2"),
                 path.map(lambda p: "//cdn.ex/" + p), st.sampled_from(["", "#k", "?only"]))


@SETTINGS
@given(st.lists(st.tuples(base, href), min_size=1, max_size=40))
def test_resolve_url_matches_urljoin(spark, pairs):
    df = spark.createDataFrame(pairs, "base string, href string")
    got = [(r["base"], r["href"], r["u"]) for r in df.select("base", "href", resolve_url("base", "href").alias("u")).collect()]
    for b, h, u in got:
        assert u == urljoin(b, h), (b, h, u, urljoin(b, h))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 100)), min_size=1, max_size=60),
       st.integers(1, 9))
def test_keep_last_matches_pandas(spark, data, parts):
    rows = [(k, t, o, f"v{o}") for o, (k, t, _) in enumerate(data)]
    df = spark.createDataFrame(rows, "k int, t int, o int, v string").repartition(parts)
    got = sorted(map(tuple, C.keep_last(df, ["k", "t"], ["t", "o"]).collect()))
    pdf = pd.DataFrame(rows, columns=["k", "t", "o", "v"])
    exp = sorted(map(tuple, pdf.sort_values("o").drop_duplicates(["k", "t"], keep="last").itertuples(index=False)))
    assert got == exp


reading = st.tuples(
    st.sampled_from(["X", "Y", "Z", None]),
    st.integers(0, 71),                       # hour offset over three days
    st.one_of(st.none(), st.floats(-100, 100, allow_nan=False)),
    st.one_of(st.none(), st.floats(-5, 20, allow_nan=False)),
)


@SETTINGS
@given(st.lists(reading, min_size=1, max_size=80))
def test_daily_weather_matches_dictionaries(spark, data):
    t0 = dt.datetime(2025, 9, 8)
    rows = [(c, t0 + dt.timedelta(hours=h), tp, pr, 50.0, 1.0, i) for i, (c, h, tp, pr) in enumerate(data)]
    schema = ("city string, time timestamp, temperature_2m double, precipitation double, "
              "relative_humidity_2m double, wind_speed_10m double, o long")
    got = A.daily_weather(C.clean_weather(spark.createDataFrame(rows, schema), ordinal="o")).toPandas()
    # By hand: the last row of each (city, time) stands, then sums by (city, day).
    last = {(r[0], r[1]): r for r in rows}
    exp = {}
    for city, when, temp, rain, *_ in last.values():
        if city is None:
            continue
        day = exp.setdefault((city, when.date()), {"temps": [], "rain": 0.0, "n": 0})
        day["n"] += 1
        if temp is not None and -80 <= temp <= 80:
            day["temps"].append(temp)
        if rain is not None and rain >= 0:
            day["rain"] += rain
    assert len(got) == len(exp)
    for r in got.itertuples():
        day = exp[(r.city, r.day)]
        assert r.n_obs == day["n"] and math.isclose(r.total_precip, day["rain"], abs_tol=1e-9)
        mean = sum(day["temps"]) / len(day["temps"]) if day["temps"] else math.nan
        assert (math.isnan(mean) and pd.isna(r.avg_temp)) or math.isclose(r.avg_temp, mean, abs_tol=1e-9)
