"""Property tests against brute force in plain Python (small generated inputs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfwise.functions import parse_order_date
from shelfwise.operators.dedup import first_wins
from shelfwise.operators.surrogate import dense_key

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_parse(s: str):
    """The reference's '%m/%d/%y %H:%i' with its 70-99 -> 19xx pivot."""
    try:
        date_part, time_part = s.split(" ")
        m, d, y = date_part.split("/")
        hh, mm = time_part.split(":")
        if len(y) != 2 or not all(p.isdigit() and 1 <= len(p) <= 2 for p in (m, d, hh, mm)):
            return None
        year = int(y) + (1900 if int(y) >= 70 else 2000)
        return dt.datetime(year, int(m), int(d), int(hh), int(mm))
    except ValueError:
        return None


texts = st.builds(
    lambda m, d, y, h, mi, pad: (f"{m:02d}" if pad else f"{m}") + f"/{d}/{y:02d} {h}:{mi:02d}",
    st.integers(0, 14), st.integers(0, 32), st.integers(0, 99), st.integers(0, 23),
    st.integers(0, 59), st.booleans())


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=40))
def test_parse_matches_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.t for r in df.select(parse_order_date("s").alias("t")).collect()]
    assert got == [brute_parse(v) for v in values]


rows = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 50), st.integers(0, 1000)),
                min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1], r[2]))


@SETTINGS
@given(rows)
def test_first_wins_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, a int, b int")
    got = {r.k: (r.a, r.b) for r in first_wins(df, ["k"], ["a", "b"], ["a", "b"]).collect()}
    want = {}
    for k, a, b in sorted(data):
        want.setdefault(k, (a, b))
    assert got == want


@SETTINGS
@given(st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=300, unique=True),
       st.integers(1, 6))
def test_dense_key_matches_brute_force(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(3)
    got = {r.v: r.k for r in dense_key(df, ["v"], "k", num_partitions=parts).collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(values))}
