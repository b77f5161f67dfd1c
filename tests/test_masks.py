"""Mask functions: edge cases, SQL and column form alike."""

from __future__ import annotations

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from lethe.functions import masks

CASES = {
    "fn_mask_email": (
        masks.mask_email,
        [
            (None, None), ("", ""), ("plain", "***@***.***"), ("@x.com", "***@***.***"),
            ("a@b", "a***@******.com"), ("ab@cd.org", "a***@c***.org"),
            ("john.doe@company.com", "j***e@c******.com"), ("abc@.com", "a***c@******.com"),
            ("user.1@enterprise.co.th", "u***1@e******.co.th"), ("x@y.z@w", "x***@y***.z@w"),
        ],
    ),
    "fn_mask_phone": (
        masks.mask_phone,
        [
            (None, None), ("", ""), ("123456", "XXX-XXXX"), ("abc", "XXX-XXXX"),
            ("1234567", "123-XXXX-4567"), ("12345678", "123-XXXX-5678"),
            ("021234567", "02-XXX-4567"), ("081-234-5678", "081-XXX-5678"),
            ("+66812345678", "+66-XXXX-5678"),
        ],
    ),
    "fn_mask_citizen_id": (
        masks.mask_citizen_id,
        [
            (None, None), ("", ""), ("1100500123456", "1-1005-XXXXX-45"),
            ("1-1005-00123-45-6", "1-1005-XXXXX-45"), ("123456", "12XXXXXXX56"),
            ("1", "1XXXXXXX1"), ("AB", "XXXXXXX"),
        ],
    ),
    "fn_mask_credit_card": (
        masks.mask_credit_card,
        [
            (None, None), ("", ""), ("4111-1111-1111-1234", "XXXX-XXXX-XXXX-1234"),
            ("411111111234", "XXXX-XXXX-XXXX-1234"), ("41111", "XXXX-XXXX"), ("x", "XXXX-XXXX"),
        ],
    ),
    "fn_mask_name": (
        masks.mask_name,
        [
            (None, None), ("", ""), ("   ", ""), ("Somchai Prasert", "S****** P******"),
            ("Al B", "A*** B***"), ("  Jo   Anna ", "J*** A***"), ("*** x", "**** x***"),
            ("a\tb c", "a*** c***"), ("Ünal", "Ü***"), ("Customer Name 1", "C******* N*** 1***"),
        ],
    ),
    "fn_mask_partial": (
        masks.mask_partial,
        [
            (None, None), ("", ""), ("abc", "***"), ("abcd", "****"), ("abcde", "ab*de"),
            ("1234567890", "12******90"),
        ],
    ),
    "fn_mask_salted_hash": (
        masks.mask_salted_hash,
        [
            (None, None),
            ("", "MSK_" + hashlib.sha256(b"MASKING_SALT_2026").hexdigest()[:12]),
            ("Jo", "MSK_" + hashlib.sha256(b"JoMASKING_SALT_2026").hexdigest()[:12]),
        ],
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_text_masks(spark, name):
    build, cases = CASES[name]
    frame = spark.createDataFrame([c[:1] for c in cases], "v string").coalesce(1)
    rows = frame.select(build("v").alias("column_form"), F.expr(f"{name}(v)").alias("sql")).collect()
    assert [r["column_form"] for r in rows] == [c[1] for c in cases]
    assert [r["sql"] for r in rows] == [c[1] for c in cases]


def test_partial_and_hash_arguments(spark):
    row = spark.sql(
        "SELECT fn_mask_partial('1234567890', 3, 3, 'X') p, fn_mask_partial('abcd', 0, 0) z, "
        "fn_mask_salted_hash('a', NULL) h"
    ).first()
    assert row["p"] == "123XXXX890"
    assert row["z"] == "****"
    assert row["h"] == "MSK_" + hashlib.sha256(b"a").hexdigest()[:12]


def test_date_shift_is_deterministic_and_in_range(spark):
    days = spark.range(400).select(
        F.expr("timestamp'2020-01-01 10:00:00' + make_dt_interval(cast(id as int))").alias("t")
    )
    shifted = days.select("t", masks.mask_date_shift("t", -45, 45).alias("s")).collect()
    moves = [(r["s"] - r["t"]) for r in shifted]
    assert all(abs(m.days) <= 45 and m.seconds == 0 for m in moves)
    assert len({m.days for m in moves}) > 30
    again = days.select(masks.mask_date_shift("t", -45, 45).alias("s")).collect()
    assert [r["s"] for r in again] == [r["s"] for r in shifted]
    assert spark.range(1).select(
        masks.mask_date_shift(F.lit(None).cast("timestamp")).alias("s")
    ).first()["s"] is None


def test_date_shift_does_not_depend_on_the_time_zone(spark):
    instant = datetime.datetime(2021, 5, 6, 7, 8, 9, tzinfo=datetime.timezone.utc)
    frame = spark.createDataFrame([(instant,)], "t timestamp")

    def shift():
        moved = F.unix_seconds(masks.mask_date_shift("t")) - F.unix_seconds("t")
        return frame.select(moved.alias("d")).first()["d"]

    utc = shift()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Bangkok")
    try:
        assert shift() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_other_forms(spark):
    frame = spark.createDataFrame(
        [(1234567, 1000.0, '{"cvv": "123", "n": {"a": 1}, "x": 2.5}', "id 1234567890123 ok")],
        "id long, salary double, payload string, notes string",
    )
    row = frame.select(
        masks.mask_sequential("P_", "id").alias("cut"),
        masks.mask_unique_alias("id").alias("alias"),
        masks.mask_numeric_noise("salary", "id").alias("noise"),
        masks.mask_json_merge("payload", {"cvv": '"***"', "ssn": '"X"'}).alias("json"),
        masks.mask_regex_redact("notes").alias("notes"),
        masks.mask_null("bigint").alias("nothing"),
        masks.mask_static("S").alias("static"),
    ).first()
    assert row["cut"] == "P_123456"
    assert row["alias"] == "user_1234567@masked.internal"
    assert 850 <= row["noise"] <= 1200 and row["noise"] % 100 == 0
    assert '"cvv":"***"' in row["json"] and '"ssn":"X"' in row["json"]
    assert '"n":{"a":1}' in row["json"] and "2.5" in row["json"]
    assert row["notes"] == "id [REDACTED_ID] ok"
    assert row["nothing"] is None and row["static"] == "S"


def test_masks_stay_in_generated_code(spark):
    frame = spark.range(1).select(F.col("id").cast("string").alias("v"))
    plan = frame.select(
        masks.mask_name("v").alias("a"), masks.mask_email("v").alias("b"),
        masks.mask_phone("v").alias("c"), masks.mask_salted_hash("v").alias("d"),
    )._jdf.queryExecution().executedPlan().toString()
    assert "*(1) Project" in plan and "Python" not in plan
