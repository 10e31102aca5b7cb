import itertools
from datetime import datetime, timezone

import pytest
from conftest import column

from wayword.functions import dates

LONG_FORMS = ["%Y-%m-%d %H:%M:%S", "%d-%m-%Y %H:%M", "%d/%m/%Y %H:%M", "%d.%m.%Y %H:%M"]
SHORT_FORMS = ["%d-%m-%y %H:%M", "%d/%m/%y %H:%M", "%d.%m.%y %H:%M"]


def first_fit(date, forms):
    for form in forms:
        try:
            return datetime.strptime(date, form)
        except ValueError:
            pass
    return None


def written_dates():
    days = ["1", "01", " 1", "31", "29", "0", "00", "32", "001", ""]
    months = ["2", "02", "12", "13", "0"]
    years = ["2021", "2024", "0000", "0001", "9999", "21", "69", "68", "00", "021", "12021"]
    times = ["0:0", "23:59", "24:00", "9:5", "12:60", "12:30:59", "12:30:60", "12:30:61", "1230"]
    for separator, (d, m, y, t) in zip(
        itertools.cycle("-/.-"), itertools.product(days, months, years, times)
    ):
        yield f"{d}{separator}{m}{separator}{y} {t}"
        yield f"{y}-{m}-{d} {t}"
    for gap in ("  ", "\t", "\n", " ", "", "\x0b", "T"):
        yield f"2021-03-04{gap}05:06:07"
        yield f"4.3.2021{gap}05:06"
    for date in ("04-03/2021 05:06", " 2021-03-04 05:06:07", "2021-03-04 05:06:07 ", "2021-03-04 05:06:07\n", ""):
        yield date


@pytest.fixture(scope="module")
def written():
    return sorted(set(written_dates()))


def test_post_time_agrees_with_strptime(texts, written):
    got = column(texts(*written).select(dates.parse_post_time("text")))
    wrong = [(d, g) for d, g in zip(written, got) if g != first_fit(d, LONG_FORMS)]
    assert not wrong[:10]
    assert sum(g is not None for g in got) > 100


def test_epoch_agrees_with_strptime(texts, written):
    got = column(texts(*written).select(dates.parse_epoch("text")))
    for date, seconds in zip(written, got):
        want = first_fit(date, SHORT_FORMS)
        assert seconds == (int(want.replace(tzinfo=timezone.utc).timestamp()) if want else 0), date
    assert sum(g != 0 for g in got) > 100


def test_null_dates(texts):
    df = texts(None)
    assert column(df.select(dates.parse_post_time("text"))) == [None]
    assert column(df.select(dates.has_valid_date("text"))) == [False]
    assert column(df.select(dates.parse_epoch("text"))) == [0]


def test_session_time_zone_does_not_matter(spark, texts):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # This hour does not exist in New York.
        df = texts("2021-03-14 02:30:00", "14-03-21 02:30")
        assert column(df.select(dates.parse_post_time("text")))[0] == datetime(2021, 3, 14, 2, 30)
        assert column(df.select(dates.parse_epoch("text")))[1] == 1615689000
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
