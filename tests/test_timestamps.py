from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest

from corpusmill.operators.timestamps import found, normalise_timestamps

CASES = [
    (None, "America/Sao_Paulo", "DMY", None, "blank"), ("", None, None, None, "blank"), ("   ", None, None, None, "blank"),
    ("2020-02-29", None, None, "2020-02-29", "date"), (" 2020-02-29 ", None, None, "2020-02-29", "date_only"), ("2021-02-29", None, None, "invalid", "invalid"),
    ("2020/02/29", None, None, "2020-02-29", "date_only"), ("20200229", None, None, "2020-02-29", "date_only"), ("0000-00-00", None, None, "invalid", "invalid"),
    ("05/03/2020", None, "DMY", "2020-03-05", "date_only"), ("05/03/2020", None, "MDY", "2020-05-03", "date_only"), ("31.12.19", None, "DMY", "2019-12-31", "date_only"),
    ("13/25/2020", None, "MDY", "invalid", "invalid"), ("12/25/2020", None, "MDY", "2020-12-25", "date_only"), ("9 set. 2012", None, None, "2012-09-09", "date_only"),
    ("1 de março de 2011", None, None, "2011-03-01", "date_only"), ("Apr 2, 2016", None, None, "2016-04-02", "date_only"), ("01-Aug-2017", None, None, "2017-08-01", "date_only"),
    ("1300000000", None, None, "2011-03-13T07:06:40Z", "instant"), ("1300000000999", None, None, "2011-03-13T07:06:40Z", "instant"),
    ("2015-06-01T12:00:00Z", "Europe/Lisbon", None, "2015-06-01T12:00:00Z", "instant"), ("2015-06-01T12:00:00.999999-03:00", None, None, "2015-06-01T15:00:00Z", "instant"),
    ("2015-06-01 12:00:00+0530", None, None, "2015-06-01T06:30:00Z", "instant"), ("2015-06-01 12:00:00 BRT", "Europe/Lisbon", None, "2015-06-01T15:00:00Z", "instant"),
    ("01/06/2015 12:15 AM", "UTC", "DMY", "2015-06-01T00:15:00Z", "instant"), ("01/06/2015 12:15 PM", "UTC", "DMY", "2015-06-01T12:15:00Z", "instant"), ("01/06/2015 20h42", "UTC", "DMY", "2015-06-01T20:42:00Z", "instant"),
    ("sáb, 1 out 2016 22:33", "UTC", None, "2016-10-01T22:33:00Z", "instant"), ("Fri, 01 Feb 2013 09:51:43 -0200", None, None, "2013-02-01T11:51:43Z", "instant"),
    ("2023-02-01 05:21:31 [America/New_York]", "UTC", None, "2023-02-01T10:21:31Z", "instant"), ("2023-02-01 05:21:31 [Mars/Base]", "UTC", None, "invalid", "invalid"),
    ("2020-01-01 25:00", "UTC", None, "invalid", "invalid"), ("2020-01-01 10:61", "UTC", None, "invalid", "invalid"), ("sem data", None, None, "invalid", "invalid"), ("9" * 5000, None, None, "invalid", "invalid"),
    ("2020-06-01 10:00", "No/Zone", None, "2020-06-01T10:00:00Z", "instant"),
    # A local time that occurs twice means the first; a skipped one is read with the offset before the change.
    ("2016-10-30 01:30:00", "Europe/Lisbon", None, "2016-10-30T00:30:00Z", "instant"), ("2016-03-27 01:30:00", "Europe/Lisbon", None, "2016-03-27T01:30:00Z", "instant"),
    ("2016-10-16 00:30:00", "America/Sao_Paulo", None, "2016-10-16T03:30:00Z", "instant"), ("2016-02-20 23:30:00", "America/Sao_Paulo", None, "2016-02-21T01:30:00Z", "instant"),
]


def test_cases(spark):
    rows = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(CASES)], "i int, v string, tz string, o string")
    got = {r["i"]: (r["date_utc"], r["date_utc_status"]) for r in normalise_timestamps(rows, "v", "tz", "o").collect()}
    assert {CASES[i][0]: v for i, v in got.items() if v != CASES[i][3:]} == {}


def test_local_times_match_the_time_zone_database(spark):
    from datetime import timedelta

    base = [datetime(2017, 3, 26) + timedelta(minutes=37 * k) for k in range(400)] + [datetime(2018, 11, 3, 22) + timedelta(minutes=17 * k) for k in range(200)]
    zones = ["Europe/Lisbon", "America/Sao_Paulo", "America/New_York"]
    data = [(z, t.strftime("%Y-%m-%d %H:%M:%S")) for z in zones for t in base]
    got = normalise_timestamps(spark.createDataFrame(data, "tz string, v string"), "v", "tz").collect()
    for r in got:
        local = datetime.strptime(r["v"], "%Y-%m-%d %H:%M:%S").replace(tzinfo=ZoneInfo(r["tz"]), fold=0)
        assert r["date_utc"] == local.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"), r


def test_found_with_clashing_columns_and_empty_tables(spark):
    registry = spark.createDataFrame([("a", "UTC", "DMY")], "dataset_name string, home_tz string, date_order string")
    main = spark.createDataFrame([(1, "a", "2020-01-01", "x"), (2, "b", "1/2/2020", "y"), (2, "b", "1/2/2020", "y"), (3, None, None, "z")], "rid bigint, dataset_name string, date_iso string, home_tz string")
    assert sorted(map(tuple, found(main, registry).collect())) == [(2, "2020-02-01"), (2, "2020-02-01")]
    assert found(main.limit(0), registry).count() == 0
    assert found(main, registry.limit(0)).count() == 2


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_session_time_zone_does_not_matter(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([("2015-06-01 12:00:00", "Europe/Lisbon")], "v string, tz string")
        assert normalise_timestamps(rows, "v", "tz").first()["date_utc"] == "2015-06-01T11:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
