"""Abbreviations in words; a text without any is looked at once."""

from quarrylens.functions import language as la


def test_abbreviations_are_written_out(spark):
    rows = spark.createDataFrame([("Acct$Amt Bal",), ("Min Max Minx",), ("From Branch",), (None,)], "w string")
    assert [r[0] for r in rows.select(la.written_out(rows.w)).collect()] == ["Account$Amount Balance", "Minimum Maximum Minx", "From Branch", None]
