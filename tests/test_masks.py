"""Masks with what they show and read; elements that are refused by name."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarrylens.functions import masks

AT = datetime(2024, 3, 5, 15, 4, 9, 123456)
DATES = {
    "YYYY-MM-DD": "2024-03-05", "DD/MM/YYYY HH24:MI:SS": "05/03/2024 15:04:09", "DD-MON-RR": "05-MAR-24", "Dd Mon YYYY": "05 Mar 2024", "fmDay, Ddth Month YYYY": "Tuesday, 5th March 2024", "DAY": "TUESDAY  ", "Month|": None, "FMMonth DD": "March 5",
    "HH12:MI AM": "03:04 PM", "hh:mi p.m.": "03:04 p.m.", "YYYYMMDDHH24MISS": "20240305150409", "DDD": "065", "Q": "1", "WW W IW": "10 1 10", "J": "2460375", "SSSSS": "54249", "FF3": "123", "DD\"th of \"MONTH": "05th of MARCH    ", "D DY dy": "3 TUE tue",
    "CC": "21", "Y,YYY": "2,024", "RM": "III ", "IYYY-IW": "2024-10", "YY.Y": "24.4", "YYYY\"year\"": "2024year",
}


@pytest.mark.parametrize("mask", list(DATES))
def test_dates_shown(spark, mask):
    row = spark.createDataFrame([(AT,)], "x timestamp")
    if DATES[mask] is None:
        with pytest.raises(ValueError):
            masks.to_char(F.col("x"), mask)
    else:
        assert row.select(masks.to_char(F.col("x"), mask)).first()[0] == DATES[mask]


READ = [
    ("2024-03-05", "YYYY-MM-DD", datetime(2024, 3, 5)), ("5/3/2024", "DD/MM/YYYY", datetime(2024, 3, 5)), ("05-mar-24", "DD-MON-YY", datetime(2024, 3, 5)), ("05-MAR-98", "DD-MON-RR", datetime(1998, 3, 5)), ("05-MAR-49", "DD-MON-RR", datetime(2049, 3, 5)),
    ("20240305150409", "YYYYMMDDHH24MISS", datetime(2024, 3, 5, 15, 4, 9)), ("March 5, 2024", "Month DD, YYYY", datetime(2024, 3, 5)), ("2024-03-05 03:04 pm", "YYYY-MM-DD HH:MI AM", datetime(2024, 3, 5, 15, 4)), ("2024-065", "YYYY-DDD", datetime(2024, 3, 5)),
    ("2024-03-05 15:04:09.123", "YYYY-MM-DD HH24:MI:SS.FF3", datetime(2024, 3, 5, 15, 4, 9, 123000)), ("2024-02-30", "YYYY-MM-DD", None), ("none", "YYYY-MM-DD", None), ("2024year03", "YYYY\"year\"MM", datetime(2024, 3, 1)),
]


@pytest.mark.parametrize("text, mask, want", READ)
def test_dates_read(spark, text, mask, want):
    assert spark.createDataFrame([(text,)], "x string").select(masks.to_timestamp(F.col("x"), mask)).first()[0] == want


NUMBERS = [
    ("1234.5", "9,999.99", " 1,234.50"), ("-1234.5", "9G999D99", "-1,234.50"), ("12", "0000", " 0012"), ("0", "999", "   0"), ("0.5", "99.99", "   .50"), ("0.5", "90.99", "  0.50"), ("1234", "999", "####"), ("12.3", "FM999.990", "12.300"), ("12.3", "FM999.909", "12.30"), ("12", "FM999.99", "12."),
    ("-12", "999MI", " 12-"), ("12", "999MI", " 12 "), ("-12", "999PR", " <12>"), ("12", "S999", " +12"), ("-12", "999S", " 12-"), ("1234", "$9,999", " $1,234"), ("1234567", "9,999,999", " 1,234,567"), ("12", "9,999", "    12"), ("99.995", "999.99", " 100.00"), ("-0.001", "9.99", "  .00"),
]


@pytest.mark.parametrize("value, mask, want", NUMBERS)
def test_numbers_both_ways(spark, value, mask, want):
    x = F.lit(value).cast("decimal(20,6)")
    shown, back = spark.range(1).select(masks.number_to_char(x, mask), masks.to_number(F.lit(want), mask)).first()
    assert shown == want
    if "#" in want:
        assert back is None
    else:
        places = len(mask.split(".")[1].rstrip("SMIPR")) if "." in mask else 2 if "D" in mask else 0
        assert back == round(Decimal(value) + Decimal(0), places) or abs(back - Decimal(value)) <= Decimal("0.5").scaleb(-places)


@pytest.mark.parametrize("mask, name", [("YYYYSP", "YYYYSP"), ("TZR", "TZR"), ("DS", "DS"), ("YYYY%", "%")])
def test_refused_dates(spark, mask, name):
    with pytest.raises(ValueError, match=name):
        masks.to_char(F.current_timestamp(), mask)


@pytest.mark.parametrize("mask, name", [("9.99EEEE", "EEEE"), ("RN", "RN"), ("L999", "L"), ("XXXX", "X")])
def test_refused_numbers(spark, mask, name):
    with pytest.raises(ValueError, match=name):
        masks.number_to_char(F.lit(1), mask)
    with pytest.raises(ValueError, match="WW"):
        masks.to_timestamp(F.lit("x"), "YYYY WW")


def test_nulls_and_many_rows(spark):
    df = spark.createDataFrame([(None, None), (AT, 5)], "x timestamp, n int")
    assert [tuple(r) for r in df.select(masks.to_char(F.col("x"), "YYYY"), masks.number_to_char(F.col("n"), "99"), masks.to_number(F.lit(None).cast("string"), "99")).collect()] == [(None, None, None), ("2024", "  5", None)]
