"""Fixed values and forms, spelled out."""

import pytest
from pyspark.sql import functions as F

from quorumdf.functions import names as N
from quorumdf.operators import detectors as D
from quorumdf.operators import ledger as L
from quorumdf.sources import listings


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("text, want", [
    ("Rezone Parcel ID 070 009 and Parcel No. 063 013", ["parcel:070 009", "parcel:063 013"]),
    ("Parcel G06 107A; parcel # 12-345", ["parcel:G06 107A", "parcel:12-345"]),
    ("Variance at 1110 Dodge Lane, 210 Robinson  Avenue", ["addr:1110 DODGE LANE", "addr:210 ROBINSON AVENUE"]),
    ("Approve the minutes of 12 May", []),
])
def test_parcels_and_addresses(spark, text, want):
    assert one(spark, D.parcel_ids(F.lit(text))) == want


@pytest.mark.parametrize("text, want", [
    ("Mayor Pro-Tem Eric Blair", "Eric Blair"), ("Vice-Chairman Lee", "Lee"), ("Councilmeber Ann Lee", "Ann Lee"), ("Alderwoman Hon Lee", "Lee"),
])
def test_titles(spark, text, want):
    assert one(spark, N.strip_title(F.lit(text))) == want


@pytest.mark.parametrize("a, b", [("Doug", "Douglas"), ("Ed", "Edward"), ("Ted", "Edward"), ("Rich", "Richard"), ("Sue", "Susan"), ("Peggy", "Margaret"), ("Jack", "John"), ("Jacqueline", "Jackie")])
def test_nicknames(spark, a, b):
    assert one(spark, N.first_names_agree(F.lit(a), F.lit(b))) is True


@pytest.mark.parametrize("text, want", [
    ("Work Session", "workshop"), ("Special Called Meeting", "special"), ("Emergency Meeting", "emergency"), ("Executive Session", "executive_session"), ("Council Meeting", "regular"),
])
def test_meeting_types(spark, text, want):
    assert one(spark, listings.meeting_type(F.lit(text))) == want


@pytest.mark.parametrize("text", ["Posted January 5, 2025 4:30 PM", "posted on january 5, 2025  4:30 pm", "POSTED Jan 5, 2025 4:30PM"])
def test_posted_stamps(spark, text):
    assert str(one(spark, listings.posted_stamp(F.lit(text)))) == "2025-01-05 16:30:00"


def test_staff_and_generic_petitioners(spark):
    rows = spark.createDataFrame([(1, "N/A"), (2, "City Treasurer"), (3, "Ann Lee"), (4, "Code Officer"), (5, "Planning Staff"), (6, "x")], "motion_id int, petitioner string")
    assert [r.motion_id for r in D.generic_petitioner(rows).collect()] == [1, 6]
    assert [(r.motion_id, r.matched) for r in D.petitioner_is_staff(rows).collect()] == [(2, "treasurer"), (4, "officer")]


def test_prices_by_prefix(spark):
    usage = spark.createDataFrame([("u", p, 10**6, 10**6, 0, 0, 0) for p, _, _ in L.PRICES] + [("u", "other", 10**6, 0, 10**6, 10**6, 1)], "unit_id string, model string, input long, output long, cache_read long, cache_write long, pages long")
    got = {r.model: r.cost for r in L.usage_cost(usage).collect()}
    assert [got[p] for p, _, _ in L.PRICES] == [90.0, 18.0, 6.0, 4.8, 18.0] and got["other"] == 15 + 1.5 + 18.75 + 0.001
