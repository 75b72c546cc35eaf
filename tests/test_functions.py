"""Edge cases of the column functions, from hand-written rows."""

from __future__ import annotations

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from skyledger import functions as fn
from skyledger.functions import keys, vocab


def one(spark, build, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(build(F.col("v")).alias("out")).first()[0]


@pytest.mark.parametrize(
    "value,padded,bare",
    [(" paid ", "_PAID_", "PAID"), ("mobile app", "MOBILE_APP", "MOBILE_APP"), ("\tweb\n", "\tWEB\n", "WEB"), (None, None, None)],
)
def test_token_orders_differ_on_padding(spark, value, padded, bare):
    assert one(spark, fn.token_replace_first, value) == padded
    assert one(spark, fn.token_trim_first, value) == bare


@pytest.mark.parametrize(
    "value,staged,feature",
    [("JFK-T1", "JFK", "JFK"), (" jfk-T1 ", "JFK", "JFK-T1"), ("jfk-t1", "JFK", "JFK-T1"), ("JFK-TX", "JFK-TX", "JFK-TX")],
)
def test_terminal_suffix(spark, value, staged, feature):
    assert one(spark, fn.strip_terminal, value) == staged
    assert one(spark, fn.strip_terminal_feature, value) == feature


@pytest.mark.parametrize(
    "text,is_number",
    [("1", True), (" 12.5 ", True), ("1e5", True), ("1_000", True), (".5", True), ("5.", True), ("nan", True),
     ("-inf", True), ("+1", True), ("1.0d", False), ("2F", False), ("0x1p3", False), ("1__0", False), ("", False),
     (None, False), ("abc", False), ("1,5", False)],
)
def test_number_syntax(spark, text, is_number):
    assert one(spark, fn.is_number, text) is is_number
    if is_number:
        assert str(one(spark, fn.try_number, text)) == str(float(text))


@pytest.mark.parametrize(
    "text,day",
    [("2026-04-01", datetime.date(2026, 4, 1)), ("2026-04-01 10:00:00", datetime.date(2026, 4, 1)), ("2026", None),
     ("2026-13-01", None), ("not-a-date", None), (None, None)],
)
def test_date_needs_a_full_iso_prefix(spark, text, day):
    assert one(spark, fn.try_date, text) == day


@pytest.mark.parametrize(
    "text,dirty",
    [("PAID", False), (" PAID", True), ("paid", True), ("A B", True), ("", False), (None, False), ("A_B", False), ("X\n", True)],
)
def test_dirty_token(spark, text, dirty):
    assert one(spark, fn.dirty_token, text) is dirty


def test_routes_treat_null_differently(rows):
    df = rows([("A", None), (None, "B"), ("A", "B")], "o string, d string")
    assert [r[0] for r in df.select(fn.route("o", "d")).collect()] == ["A-", "-B", "A-B"]
    assert [r[0] for r in df.select(fn.route_ws("o", "d")).collect()] == ["A", "B", "A-B"]


@pytest.mark.parametrize("name", ["abc", "BKG-1|2026-03-01 00:45:00|7", "é|ü", ""])
def test_uuid5_is_the_standard_one(spark, name):
    assert one(spark, fn.uuid5, name) == str(uuid.uuid5(uuid.NAMESPACE_URL, name))
    assert one(spark, lambda c: fn.uuid5(c, keys.NAMESPACE_DNS), name) == str(uuid.uuid5(uuid.NAMESPACE_DNS, name))


@pytest.mark.parametrize(
    "text,words", [("TRUE", True), (" t ", True), ("1", True), ("Y", True), ("no", False), ("", False), (None, False)]
)
def test_bool_words(spark, text, words):
    assert one(spark, fn.bool_words, text) is words


@pytest.mark.parametrize(
    "token,table,term",
    [("CHARGEBACK", vocab.PAYMENT_STATUS, "REFUNDED"), ("_PAID_", vocab.PAYMENT_STATUS, "FAILED"), (None, vocab.PAYMENT_STATUS, "FAILED"),
     ("ON_HOLD", vocab.BOOKING_STATUS, "PENDING"), ("ON_HOLD", vocab.BOOKING_STATUS_FEATURE, "ON_HOLD"),
     ("PHONE", vocab.BOOKING_CHANNEL, "CALL_CENTER"), ("VISA", vocab.PAYMENT_METHOD, "CREDIT_CARD"),
     ("CONF", vocab.BOOKING_EVENT_TYPE, "BOOKING_UPDATED"), ("PAID", vocab.PAYMENT_EVENT_TYPE, "PAYMENT_CAPTURED")],
)
def test_vocabularies(spark, token, table, term):
    assert one(spark, lambda c: fn.map_vocab(c, table), token) == term


def test_ratio_by_zero_is_null(rows):
    assert rows([(1, 0)], "a int, b int").select(fn.ratio(F.col("a"), F.col("b"))).first()[0] is None


def test_greatest_ignores_null(rows):
    out = rows([(None,), (-1.0,), (2.0,)], "a double").select(fn.floor_at("a", 0.0)).collect()
    assert [r[0] for r in out] == [0.0, 0.0, 2.0]


@pytest.mark.parametrize("text,is_object", [('{"a":1}', True), ("[1]", False), ('"x"', False), ("{bad", False), (None, False)])
def test_json_object(spark, text, is_object):
    assert one(spark, fn.json_is_object, text) is is_object


@pytest.mark.parametrize("text,ok", [("2026-04-01T10:00:00Z", True), ("2026-04-01T12:00:00+02:00", True), ("yesterday", False)])
def test_iso_time(spark, text, ok):
    at = one(spark, lambda c: fn.iso_z(c).cast("string"), text)
    assert at == ("2026-04-01 10:00:00" if ok else None)


def test_like_any_and_calendar(rows):
    df = rows([("x/generated/bookings/a",), ("x/other/a",)], "p string")
    assert df.where(fn.like_any("p", ["%/generated/bookings/%", "%/validated/%"])).count() == 1
    sunday = rows([(datetime.date(2026, 4, 5),)], "d date").select(*fn.calendar("d")).first()
    assert tuple(sunday) == (2026, 4, 5, 0, 2)
