import json
import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.python_kernels import star_map
from shelfmark.functions.sizes import SYMBOLS, readable_bytes
from shelfmark.functions.text import replace_literal
from shelfmark.operators import reports
from tests.conftest import rows

BYTES = "%(value).1f %(symbol)s"


# Documented examples.
@pytest.mark.parametrize("n, format, symbols, text", [
    (0, BYTES, "customary", "0.0 B"), (0.9, BYTES, "customary", "0.0 B"), (1, BYTES, "customary", "1.0 B"),
    (1.9, BYTES, "customary", "1.0 B"), (1024, BYTES, "customary", "1.0 K"), (1048576, BYTES, "customary", "1.0 M"),
    (1099511627776127398123789121, BYTES, "customary", "909.5 Y"), (9856, BYTES, "customary", "9.6 K"),
    (9856, BYTES, "customary_ext", "9.6 kilo"), (9856, BYTES, "iec", "9.6 Ki"), (9856, BYTES, "iec_ext", "9.6 kibi"),
    (10000, "%(value).1f %(symbol)s/sec", "customary", "9.8 K/sec"), (10000, "%(value).5f %(symbol)s", "customary", "9.76562 K"),
    (9856, "100%% %(symbol)s:%(value).0f", "customary", "100% K:10"),
])
def test_documented_byte_examples(frame, n, format, symbols, text):
    df = frame("n decimal(38,3)", (Decimal(str(n)),))
    assert df.select(readable_bytes(F.col("n"), format, symbols)).first()[0] == text
    if n < 1 << 63:
        kind = "double" if isinstance(n, float) else "bigint"
        assert frame(f"n {kind}", (n,)).select(readable_bytes(F.col("n"), format, symbols)).first()[0] == text


def spelled(n, places):
    step = max([i for i in range(9) if n >= 1024**i] or [0])
    return f"{n / 1024**step if step else n:.{places}f} {SYMBOLS['customary'][step]}"


HALVES = st.builds(lambda k, s: (2 * k + 1) << s, st.integers(0, 5000), st.integers(0, 49))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(0, 2**63 - 1), HALVES), min_size=50, max_size=200), st.integers(0, 4))
def test_byte_counts_equal_python_formatting(spark, counts, places):
    df = spark.createDataFrame([(n,) for n in counts], "n bigint")
    text = readable_bytes(F.col("n"), f"%(value).{places}f %(symbol)s")
    assert [r.t for r in df.select(text.alias("t")).collect()] == [spelled(n, places) for n in counts]


def test_negative_counts(frame):
    df = frame("n bigint", (-1,), (None,))
    assert [r[0] for r in df.select(readable_bytes(F.col("n"))).collect()] == [None, None]
    with pytest.raises(PySparkException, match="below zero"):
        df.select(readable_bytes(F.col("n"), strict=True)).collect()
    with pytest.raises(ValueError):
        readable_bytes(F.col("n"), "%(symbol)s")


def test_storage_usage(objects):
    got = rows(reports.storage_usage(objects), "parent", "n_files", "readable")
    assert got == [("/store/home/me", 1, "7.0 B"), ("/store/home/me/data", 3, "5.9 K")]


TEXT = "a.b $1 A.B \\E x^y (q) \\Q"


@pytest.mark.parametrize("pattern, replacement", [
    ("a.b", "$0"), (".", "\\"), ("$1", "[\\1]"), ("\\E", "E"), ("(q)", "\\E$"), ("nope", "x"), ("", "-"), ("^", ""), ("\\Q", "\\Q"),
])
@pytest.mark.parametrize("ignore_case", [False, True])
def test_replacement_is_literal(frame, pattern, replacement, ignore_case):
    flags = re.IGNORECASE if ignore_case else 0
    want = re.compile(re.escape(pattern), flags).sub(lambda _: replacement, TEXT)
    got = frame("t string", (TEXT,)).select(replace_literal(F.col("t"), pattern, replacement, ignore_case))
    assert got.first()[0] == want


def test_ignore_case_knows_accents(frame):
    got = frame("t string", ("Été ÉTÉ ete",)).select(replace_literal(F.col("t"), "été", "x", ignore_case=True))
    assert got.first()[0] == "x x ete"


def without_nulls(value):
    if isinstance(value, dict):
        return {k: without_nulls(v) for k, v in value.items() if v is not None}
    return value


JSON = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6), st.text(max_size=5)),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.text(max_size=3), inner, max_size=3)),
    max_leaves=12,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(JSON, min_size=20, max_size=60))
def test_null_keys_go_through_objects_only(spark, documents):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "i int, j string")
    got = {r.i: json.loads(r.j) for r in reports.strip_nulls(df, "j").collect()}
    assert got == {i: without_nulls(d) for i, d in enumerate(documents)}


def test_text_that_is_not_json_gives_null(frame):
    df = frame("j string", ("{",), (None,), ('{"a":null,"l":[null,{"b":null}],"o":{"x":null}}',))
    assert [r.j for r in reports.strip_nulls(df, "j").collect()] == [None, None, '{"l":[null,{"b":null}],"o":{}}']


def test_outcomes(frame):
    missing, exists, failed = ('{"error_code":"ERR_%s"}' % c for c in ("DOES_NOT_EXIST", "EXISTS", "REQUEST_FAILED"))
    cases = [
        ("stat", 500, missing, "not_found"), ("stat", 400, None, "bad_request"), ("stat", 500, exists, "http_error"),
        ("list", 500, missing, "invalid_path"), ("list", 400, None, "http_error"), ("upload", 500, exists, "skipped"),
        ("upload", 500, "not json", "http_error"), ("download", 500, failed, "invalid_path"), ("token", 400, None, "unauthorized"),
        ("token", 302, None, "bad_response"), ("token", 200, None, "ok"), ("exists", 302, None, "ok"), ("user", 404, None, "http_error"),
    ]
    log = frame("endpoint string, status int, body string, want string", *cases)
    assert reports.classify_responses(log).filter("outcome <> want").count() == 0


def test_keys_and_entries(frame):
    log = frame(
        "body string, path string",
        ('{"paths":{"/a":true,"/b":false},"x":null}', "/a"), ('{"paths":{"/a":true}}', "/c"), ('{"paths":null}', "/a"),
        ('{"other":1}', "/a"), ("[1]", "/a"), ("oops", "/a"), (None, "/a"),
    )
    assert [r.complete for r in reports.require_keys(log, ["paths"]).collect()] == [True, True, True, False, False, False, False]
    assert [r.complete for r in reports.require_keys(log, ["paths", "x"]).collect()] == [True] + [False] * 6
    strict = reports.require_keys(log, ["paths"], nulls_count=False)
    assert [r.complete for r in strict.collect()] == [True, True] + [False] * 5
    assert [r.exists for r in reports.extract_entry(log).collect()] == [True] + [False] * 6


@pytest.mark.parametrize("chunksize", [None, 1, 7])
def test_star_map_calls_with_every_column(spark, chunksize):
    df = spark.range(100).selectExpr("id", "if(id % 10 = 0, null, concat('x', id)) as s")
    got = star_map(df, lambda i, s: f"{i}/{s}", ["id", "s"], "out", T.StringType(), chunksize)
    assert {r.id: r.out for r in got.collect()} == {i: f"{i}/{None if i % 10 == 0 else f'x{i}'}" for i in range(100)}


def test_star_map_rejects_a_chunksize_below_one(spark):
    with pytest.raises(ValueError):
        star_map(spark.range(1), str, ["id"], "out", T.StringType(), 0)
