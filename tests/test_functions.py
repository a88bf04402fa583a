"""Column functions on hand-written rows, malformed ones included, with ANSI on and off."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reviewmill.functions import dates, nested, rating, text
from reviewmill.schemas import ANSWER, EVENT_BODY, METADATA, METADATA_JSON


def applied(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    found = rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
    return [r.out for r in found]


def test_price(spark, ansi):
    found = applied(spark, text.price_to_float, ["$12.99", "$12.99 - $30.00", "", None, ".a-box"])
    assert found[0] == pytest.approx(12.99, rel=1e-6)
    assert found[1:] == [None] * 4


def test_price_is_32_bit(spark):
    rows = spark.createDataFrame([("$1.1",)], "v string")
    assert rows.select(text.price_to_float(F.col("v")).alias("p")).dtypes == [("p", "float")]


def test_main_category(spark, ansi):
    raw = ['<img src="x" alt="Cell Phones &amp; Accessories"/>', "books", "it's a BOOK", None]
    assert applied(spark, text.clean_category, raw) == [
        "Cell Phones & Accessories", "Books", "It's A Book", None,
    ]


def test_category_from_single_quotes(spark):
    assert applied(spark, text.clean_category, ["<img src='x' alt='toys'>", '<img src="x">']) == [
        "Toys", "",
    ]


def test_title(spark, ansi):
    raw = ["<span>x", "", "A &amp; B", 'A" />', None]
    assert applied(spark, text.clean_title, raw) == [None, None, "A & B", "A", None]


def test_entities(spark, ansi):
    raw = ["A &amp; B", "&quot;x&quot;", "&amp;quot;", None]
    assert applied(spark, text.decode_entities, raw) == ["A & B", '"x"', '"', None]


def test_word_count(spark, ansi):
    raw = ["good", "very good", "", " a b ", None, "a\n\tb"]
    assert applied(spark, text.word_count, raw) == [1, 2, 1, 4, None, 2]


def test_keyword(spark, ansi):
    found = applied(spark, lambda v: text.one_word(v, text.word_count(v)), ["good", "so so", "", None])
    assert found == ["good", None, "", None]


def test_missing_text(spark, ansi):
    assert applied(spark, text.is_missing_text, [None, "{}", "", "x"]) == [True, True, True, False]


def test_junk_values(spark, ansi):
    assert applied(spark, lambda v: text.null_if(v, "{}"), ["{}", "", None]) == [None, "", None]


def test_bytes_and_offsets(spark, ansi):
    assert applied(spark, text.decode_bytes, [bytearray("né".encode()), None], "binary") == ["né", None]
    assert applied(spark, text.text_to_long, ["12", "x", None]) == [12, None, None]


def test_unix_date_in_any_time_zone(spark, ansi):
    seconds = [1577836800, 1580515200, 1577836799, -1, None]
    days = [dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2019, 12, 31), dt.date(1969, 12, 31), None]
    for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert applied(spark, dates.unix_date, seconds, "bigint") == days
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_long_dates(spark, ansi):
    raw = ["July 1, 2014", "July 31, 2014", "July 01, 2014", "February 30, 2014", "July 1, 2014 x", "Foo", "", None]
    assert applied(spark, dates.long_date, raw) == [
        dt.date(2014, 7, 1), dt.date(2014, 7, 31), dt.date(2014, 7, 1), None, None, None, None, None,
    ]


def test_instant_is_utc_in_any_time_zone(spark, ansi):
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            found = applied(
                spark,
                lambda v: F.unix_micros(dates.instant(v)),
                ["2023-07-30 00:00:21.274000", "soon", "", None],
            )
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert found == [1690675221274000, None, None, None]


def test_run_date():
    now = dt.datetime(2024, 3, 1, 0, 30, tzinfo=dt.timezone.utc)
    assert dates.default_run_date(now) == dt.date(2024, 2, 29)


def test_date_columns(spark, ansi):
    frame = spark.createDataFrame(
        [(1, "2019-12-31", 1577750400), (2, "2024-02-29", 1709164800)], ["n", "Joined On", "Seen At"]
    )
    found = dates.unix_to_date(frame, "Seen At")
    found = dates.extract_year(dates.extract_year_month(found, "Joined On"), "Joined On")
    assert [tuple(r)[3:] for r in found.orderBy("n").collect()] == [
        (dt.date(2019, 12, 31), "2019-12", "2019"), (dt.date(2024, 2, 29), "2024-02", "2024"),
    ]
    assert found.columns[3:] == ["Seen At_date", "Joined On_year_month", "Joined On_year"]


@pytest.mark.parametrize("extract", [dates.extract_year_month, dates.extract_year])
def test_absent_date_column(spark, extract):
    frame = spark.createDataFrame([("Alice",)], ["Name"])
    with pytest.raises(ValueError) as problem:
        extract(frame, "Non-existing column")
    assert "Column 'Non-existing column' not found in DataFrame." in str(problem.value)


def test_bad_date_text_gives_null(spark, ansi):
    frame = spark.createDataFrame([("2020-01-01",), ("nonsense",)], "day string")
    assert [r.day_year for r in dates.extract_year(frame, "day").collect()] == ["2020", None]


def test_image_links(spark, ansi):
    raw = ['["88","u"]', '["88"]', "[]", '["88", null]', None, "not json", "[88, 7]"]
    assert applied(spark, nested.image_links, raw) == [["u"], None, None, [None], None, None, ["7"]]


def test_first_item(spark, ansi):
    lists = [[], None, ["a", "b"], [None, "b"]]
    assert applied(spark, nested.first_item, lists, "array<string>") == [None, None, "a", None]
    assert applied(spark, nested.first_or_unknown, lists, "array<string>") == [
        "Unknown", "Unknown", "a", "Unknown",
    ]


def test_feature_stays_empty(spark, ansi):
    found = applied(spark, lambda v: nested.without(v, ""), [["", "x"], [""], None], "array<string>")
    assert found == [["x"], [], None]


def test_rank(spark, ansi):
    raw = ['[">#1,234 in Books (","2 in Toys","none","4567 in X"]', "not json", None, '["2 in A", "1,234 in B"]']

    def all_of(value):
        entries = nested.rank_entries(value)
        return F.struct(entries.alias("entries"), nested.rank_summary(entries).alias("s"), nested.best_rank(entries).alias("best"))

    found = applied(spark, all_of, raw)
    assert [e.number for e in found[0].entries] == ["1,234", "2", "", "456"]
    assert [e.cat for e in found[0].entries] == ["Books (", "Toys", "", "X"]
    # Text order: the empty text first, and "1,234" before "2".
    assert [f.s.higher_rank for f in found] == ["", None, None, "1,234"]
    assert [f.s.cat for f in found] == ["Books (, Toys, , X", "", "", "A, B"]
    assert [f.best for f in found] == [2, None, None, 2]


def test_event_body(spark, ansi):
    raw = ['{"asin":"a","overall":5.0,"verified":true,"unknown":1}', "not json", "{}", None]
    found = applied(spark, lambda v: nested.json_struct(v, EVENT_BODY), raw)
    assert (found[0].asin, found[0].overall, found[0].verified, found[0].vote) == ("a", "5.0", "true", None)
    assert all(v is None for v in found[1].asDict().values())
    assert all(v is None for v in found[2].asDict().values())
    assert found[3] is None


def test_schemas_from_dicts():
    assert len(METADATA.fields) == 18 and METADATA["also_buy"].dataType.simpleString() == "array<string>"
    assert METADATA.jsonValue() == METADATA_JSON and len(EVENT_BODY.fields) == 12
    assert ANSWER.names == ["sentiment", "actionable", "keywords", "response"]


def test_deviation_labels(spark, ansi):
    found = applied(spark, rating.deviation_label, [0.5, -0.5, 0.0, None], "double")
    assert found == ["better", "worse", "normal", "normal"]


def test_keyword_sentiment(spark, ansi):
    rows = spark.createDataFrame(
        [("good", 5.0), ("good", 4.0), ("bad", 2.0), ("bad", 0.0), ("so", 3.0), (None, 5.0), ("x", None)],
        "keyword string, overall double",
    )
    found = rows.select(rating.keyword_sentiment(F.col("keyword"), F.col("overall")).alias("s")).collect()
    assert [r.s for r in found] == ["positive", "positive", "negative", "negative", None, None, None]


def test_seconds_out_of_range(spark, ansi):
    found = applied(spark, dates.unix_date, [10**18, -(10**18), 86400, None], "bigint")
    assert found == [None, None, dt.date(1970, 1, 2), None]


@pytest.mark.parametrize("written", ["2023-12-31", "2023-12-31 00:00:00", "2023-12-31T00:00:00Z", "2023-12-31 01:00:00.000000+01:00"])
def test_moments(written):
    assert dates.parse_moment(written) == dt.datetime(2023, 12, 31, tzinfo=dt.timezone.utc)


@pytest.mark.parametrize("written", ["", "soon", "2023-13-01", "31.12.2023"])
def test_moments_that_are_none(written):
    with pytest.raises(ValueError, match="is not a moment"):
        dates.parse_moment(written)
