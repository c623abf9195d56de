"""Property tests: column rules against a plain-Python model of the rule,
over generated JSON values (one Spark job per generated batch)."""
import json
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsengine.functions import numbers, text

INT_TEXT = re.compile(r"0|-?[1-9][0-9]*")
WS = st.sampled_from(["", " ", "  ", "\t", "\n", " \t"])


def model_delay(v):
    """The delay rule as written in the contract (see functions/numbers.py)."""
    if v is None:
        return None, None
    if isinstance(v, bool) or isinstance(v, (list, dict)):
        return None, "invalid delay"
    if isinstance(v, int):
        n = v
    elif isinstance(v, float):
        if not v.is_integer():
            return None, "invalid delay"
        n = int(v)
    else:
        s = v.strip(" \t\n")
        if not INT_TEXT.fullmatch(s):
            return None, "invalid delay"
        n = int(s)
    if not -(2 ** 31) <= n <= 2 ** 31 - 1:
        return None, "invalid delay"
    return (None, "negative delay") if n < 0 else (n, None)


delay_values = st.one_of(
    st.none(), st.booleans(), st.integers(-10 ** 12, 10 ** 12),
    st.integers(-500, 500).map(float),
    st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False).map(lambda x: round(x, 2)),
    st.builds(lambda a, n, b: f"{a}{n}{b}", WS, st.integers(-1000, 1000), WS),
    st.sampled_from(["+27", "027", "27.0", "2 7", "", "-0", "1_000", "x"]),
    st.just([]), st.just({"a": 1}),
)


@settings(max_examples=4, deadline=None)
@given(st.lists(delay_values, min_size=50, max_size=120))
def test_delay_matches_model(spark, values):
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, j string").select(
        "i", numbers.delay_minutes(F.parse_json("j"), F.parse_json(F.lit("null"))).alias("r"))
    got = {r.i: (r.r["value"], r.r["error"]) for r in df.collect()}
    for i, v in enumerate(values):
        assert got[i] == model_delay(v), (v, got[i])


codes = st.builds(lambda a, s, b: a + s + b, WS,
                  st.text(alphabet="abcXYZ019-", min_size=0, max_size=6), WS)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(codes, st.integers(0, 99), st.none()), min_size=30, max_size=80))
def test_code_matches_model(spark, values):
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, j string").select(
        "i", text.code(F.parse_json("j")).alias("u"), text.code(F.parse_json("j"), upper=False).alias("l"),
        text.label(F.parse_json("j")).alias("b"))
    got = {r.i: (r.u, r.l, r.b) for r in df.collect()}
    for i, v in enumerate(values):
        s = v.strip() if isinstance(v, str) else None
        s = s or None
        want = (s.upper() if s else None, s.lower() if s else None, s)
        assert got[i] == want, (v, got[i])
