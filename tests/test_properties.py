"""Property tests: Column expressions against their plain-Python definitions."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from newsrisk.functions import normalize_root_code, tone_bucket

CODE_TEXT = st.text(alphabet=st.sampled_from(list("0123456789+-X ab\t\n")), max_size=5)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), CODE_TEXT), min_size=1, max_size=40))
def test_normalize_codes_equals_strip_zfill(spark, codes):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, c string")
    got = [r[0] for r in df.orderBy("i").select(normalize_root_code("c")).collect()]
    assert got == [None if c is None else c.strip().zfill(2) for c in codes]


def _bucket(t):
    if t is None or math.isnan(t):
        return "unknown"
    if t <= -2:
        return "negative"
    if t >= 2:
        return "positive"
    return "neutral"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(allow_infinity=True, allow_nan=True, width=64),
                          st.sampled_from([-2.0, 2.0, -1.9999999999999998, 1.9999999999999998])),
                min_size=1, max_size=40))
def test_tone_bucket_equals_rule(spark, tones):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tones)], "i int, t double")
    got = [r[0] for r in df.orderBy("i").select(tone_bucket("t")).collect()]
    assert got == [_bucket(t) for t in tones]
