import datetime as dt
from zoneinfo import ZoneInfo

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions.zones import zone_table
from tidemark.operators.timestamps import Normaliser, normalise_timestamps, parser_of, shape, zone_tables

CASES = {
    "Monday 23 March 2020  7:39pm": "2020-03-23T08:39:00Z", "28/11/2019": "2019-11-28", "04/16/2022  9am": "2022-04-15T23:00:00Z",
    "2020-03-07 17:00:00+0930": "2020-03-07T07:30:00Z", "2022-03-08 23:52:00.5Z": "2022-03-08T23:52:00Z", "20240408T013000+1000": "2024-04-07T15:30:00Z",
    "2024-01-26T06:47:00[Australia/Brisbane]": "2024-01-25T20:47:00Z", "10 Oct '23": "2023-10-10", "5.7.23": "2023-07-05", "1682949540000": "2023-05-01T13:59:00Z",
    "1682949540": "2023-05-01T13:59:00Z", "202506111200": "2025-06-11T02:00:00Z", "20200803": "2020-08-03", "12 noon (UTC), 3 July 2023": "2023-07-03T12:00:00Z",
    "5 April 2020 2:44am AEST": "2020-04-04T16:44:00Z", "5 April 2020 2:44am AEDT": "2020-04-04T15:44:00Z", "31 June 2024 11:59pm AEST": None, "29 February 2023": None,
    "29 February 2024": "2024-02-29", "12 Foo 2021": None, "Q3 2024": None, "11:59pm AEST": None, "Friday": None, "": None, None: None, "00/11/2025": None, "2020-13-02": None,
    "30/02/2024": None, "21 January 2023 at 0330 hrs - no late applications": "2023-01-20T16:30:00Z", "Mon, 16 Oct 2023 1630 hrs": "2023-10-16T05:30:00Z",
    "9.9.24  03:30 sharp": "2024-09-08T17:30:00Z", "5:00 PM Melbourne time, Friday 22 April 2022": "2022-04-22T07:00:00Z", "2023-03-27 23:30 Australia/Adelaide": "2023-03-27T13:00:00Z",
    "12:30 AM (AEST) June 12, 2023": "2023-06-11T14:30:00Z", "Closing: 12-APR-2020": "2020-04-12", "3 May 2024 25:70": "2024-05-03", "3 May 2024 24:00": "2024-05-03T14:00:00Z",
}


ZONED = {
    "2024-05-01 17:00 America/New_York": "2024-05-01T21:00:00Z", "2024-05-01 17:00 Asia/Tokyo": "2024-05-01T08:00:00Z", "2024-01-15 09:00 America/Port-au-Prince": "2024-01-15T14:00:00Z",
    "2024-05-01 17:00 America/Argentina/Buenos_Aires": "2024-05-01T20:00:00Z", "2024-05-01 17:00 Etc/GMT+10": "2024-05-02T03:00:00Z", "2024-07-01 17:00 Europe/Paris": "2024-07-01T15:00:00Z", "2024-05-01 17:00 US/Eastern": "2024-05-01T21:00:00Z",
    "2024-05-01 17:00 Asia/Nowhere": None, "1 May 2024 5pm EST": None, "1 May 2024 5:00 pm (WAST)": None, "1 May 2024 EST": "2024-05-01", "1 May 2024 5pm SHARP": "2024-05-01T07:00:00Z",
}


@pytest.fixture(scope="module")
def convert():
    tool = Normaliser(zone_tables(), "Australia/Sydney")

    def one(text):
        row = tool(pd.Series([text], dtype=object)).iloc[0]
        stamp = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=int(row["seconds"]))
        return {0: None, 1: stamp.strftime("%Y-%m-%d"), 2: stamp.strftime("%Y-%m-%dT%H:%M:%SZ")}[row["state"]]

    return one


@pytest.mark.parametrize("text", list(ZONED))
def test_zones_of_the_world_and_unknown_ones(convert, text):
    assert convert(text) == ZONED[text]


@pytest.mark.parametrize("text", list(CASES))
def test_forms(convert, text):
    assert convert(text) == CASES[text]


def test_one_parser_for_a_mask():
    masks = {shape(x)[0] for x in ("3 May 2024", "9 July 1999", "1 december 2020")}
    assert len(masks) == 1 and parser_of(masks.pop()).kind == "words"


@settings(max_examples=200, deadline=None)
@given(st.datetimes(dt.datetime(2008, 6, 1), dt.datetime(2037, 1, 1)), st.sampled_from(["Australia/Sydney", "Australia/Adelaide", "Pacific/Auckland", "Australia/Perth"]))
def test_zone_tables_agree_with_the_database(moment, name):
    want = int(moment.replace(tzinfo=ZoneInfo(name), fold=0).timestamp() // 1)
    wall = int((moment - dt.datetime(1970, 1, 1)).total_seconds() // 1)
    assert int(zone_table(name).to_utc(pd.Series([wall]).to_numpy())[0]) == want


def test_column(spark):
    rows = [(1, "3 May 2024 5pm AEST"), (2, "3 May 2024"), (3, None), (4, "x" * 200_000 + " 1"), (4, "x" * 200_000 + " 1"), (5, "")]
    df = spark.createDataFrame(rows, "closing long, raw string")
    out = {r["closing_id"]: r for r in normalise_timestamps(df.withColumnRenamed("closing", "closing_id"), "raw").collect()}
    assert out[1]["closing"]["closing_norm"] == "2024-05-03T07:00:00Z" and out[1]["closing"]["plain_date"] is None
    assert out[2]["closing"]["plain_date"] == dt.date(2024, 5, 3) and out[2]["closing"]["instant_utc"] is None
    assert out[3]["closing"]["closing_norm"] is None and out[4]["closing"]["closing_norm"] is None
    assert normalise_timestamps(df.limit(0), "raw").count() == 0
    assert normalise_timestamps(df, "raw", into="closing").count() == 6
