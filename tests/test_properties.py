"""Property tests: the money and text->int helpers agree with the source engine."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendstar.functions import exprs as X

finite = st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False)
# decimal texts with up to 6 fraction digits, optional exponent (the lenient forms)
int_texts = st.builds(
    lambda sign, whole, frac, exp: f"{sign}{whole}{'.' + frac if frac else ''}{'e' + str(exp) if exp is not None else ''}",
    st.sampled_from(["", "-", "+"]),
    st.integers(min_value=0, max_value=99999),
    st.text(alphabet="0123456789", max_size=6),
    st.one_of(st.none(), st.integers(min_value=0, max_value=3)),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(finite, min_size=50, max_size=300))
def test_r2_equals_engine_round(spark, xs):
    got = [r.r for r in spark.createDataFrame([(x,) for x in xs], "x double").select(X.r2(F.col("x")).alias("r")).collect()]
    con = duckdb.connect()
    want = [con.execute("select round(?::double, 2)", [x]).fetchone()[0] for x in xs]
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(int_texts, min_size=20, max_size=150))
def test_text_to_int_equals_engine_cast(spark, texts):
    con = duckdb.connect()
    expected = {}
    for t in texts:
        try:
            expected[t] = con.execute("select cast(trim(?) as integer)", [t]).fetchone()[0]
        except duckdb.Error:
            continue
    if not expected:
        return
    df = spark.createDataFrame([(t,) for t in expected], "t string").select("t", X.to_int_strict("t").alias("v"))
    got = {r.t: r.v for r in df.collect()}
    assert got == expected


names = st.text(alphabet="abcXYZ -\t09 　 ​\n", max_size=16)
CANONICAL_SQL = (
    "select array_to_string(list_transform(string_split(trim(lower(?)), ' '), "
    "lambda x: upper(left(x, 1)) || substr(x, 2)), ' '), trim(?)"
)


@settings(max_examples=5, deadline=None)
@given(st.lists(names, min_size=20, max_size=150, unique=True))
def test_title_case_and_trim_equal_engine(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", X.canonical_name("t").alias("c"), X.trim_zs("t").alias("z")
    )
    got = {r.t: (r.c, r.z) for r in df.collect()}
    con = duckdb.connect()
    want = {t: tuple(con.execute(CANONICAL_SQL, [t, t]).fetchone()) for t in texts}
    assert got == want


def _date_text(year, month, day, sep, pad, suffix, space):
    m = f"{month:02d}" if pad else str(month)
    d = f"{day:02d}" if pad else str(day)
    return f"{space}{year}{sep}{m}{sep}{d}{suffix}{space}"


date_texts = st.one_of(
    st.builds(
        _date_text,
        st.integers(min_value=1000, max_value=2999),
        st.integers(min_value=0, max_value=13),
        st.integers(min_value=0, max_value=32),
        st.sampled_from(["-", "/"]),
        st.booleans(),
        st.sampled_from(["", " 10:00:00", "T10:00"]),
        st.sampled_from(["", " ", "　"]),
    ),
    st.builds(lambda y, m: f"{y}-{m:02d}", st.integers(min_value=1000, max_value=2999), st.integers(1, 12)),
    st.builds(str, st.integers(min_value=1000, max_value=2999)),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(date_texts, min_size=20, max_size=120, unique=True))
def test_text_to_date_equals_engine_cast(spark, texts):
    con = duckdb.connect()
    ok, bad = {}, []
    for t in texts:
        try:
            ok[t] = con.execute("select cast(trim(?) as date)", [t]).fetchone()[0]
        except duckdb.Error:
            bad.append(t)
    if ok:
        df = spark.createDataFrame([(t,) for t in ok], "t string").select("t", X.to_date_strict("t").alias("d"))
        assert {r.t: r.d for r in df.collect()} == ok
    for t in bad[:2]:  # each rejected text must fail the Spark job too
        one = spark.createDataFrame([(t,)], "t string").select(X.to_date_strict("t").alias("d"))
        try:
            one.collect()
        except Exception:  # noqa: BLE001
            continue
        raise AssertionError(f"Spark accepted {t!r}, the source engine rejects it")
