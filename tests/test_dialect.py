from decimal import Decimal

from pyspark.sql import functions as F, types as T

from quarrylens.functions import oracle as o
from quarrylens.operators import banking as b


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_null_semantics(spark):
    assert one(spark, o.greatest(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, o.concat_nulls(F.lit("a"), F.lit(None), F.lit("b"))) == "ab"
    assert one(spark, o.empty_is_null(F.lit(""))) is None
    assert one(spark, o.number_text(F.lit("3.000").cast("decimal(6,3)"))) == "3"
    assert one(spark, o.number_text(F.lit("3.500").cast("decimal(6,3)"))) == "3.5"
    assert one(spark, o.dec_round(F.lit("2.005").cast("decimal(10,3)"))) == Decimal("2.01")
    assert one(spark, o.days_between(F.lit("2026-01-02 12:00:00").cast("timestamp"), F.lit("2026-01-01").cast("timestamp"))) == Decimal("1.5")


def test_types():
    assert o.map_type("NUMBER(18,2)") == ("DECIMAL", T.DecimalType(18, 2))
    assert o.map_type("NUMBER") == ("DECIMAL", T.DecimalType(38, 10))
    assert o.map_type("NUMBER(5,0)")[1] == T.DecimalType(5, 0)
    assert o.map_type("VARCHAR2(20)") == ("STRING", T.StringType())
    assert o.map_type("DATE")[1] == T.TimestampType()
    assert o.map_type("DOUBLE PRECISION")[1] == T.DoubleType()
    assert o.map_type("RAW(16)")[1] == T.BinaryType()


def test_routines_on_known_values(spark):
    interest, error = b.simple_interest(F.lit(100000), F.lit("7.5").cast("decimal(8,4)"), F.lit(180), F.lit("365"))
    assert one(spark, interest) == Decimal("3698.63") and one(spark, error) is None
    _, penalty, outcome = b.minimum_balance_check(F.lit("3200").cast("decimal(18,2)"), F.lit("CURRENT_REGULAR"))
    assert (one(spark, penalty), one(spark, outcome)) == (Decimal("90.00"), "BELOW_MINIMUM_BALANCE")
    accounts = spark.createDataFrame([("A", "SAVINGS_REGULAR", "ACTIVE", 45000.0), ("B", "SAVINGS_PREMIUM", "ACTIVE", 1250000.0), ("C", "TERM_DEPOSIT", "ACTIVE", 1.0), ("D", "SAVINGS_REGULAR", "DORMANT", 1.0)], "account_number string, account_type string, account_status string, balance double")
    got = b.monthly_interest(accounts, F.to_date(F.lit("2026-06-30")))
    assert {(r.account_number, str(r.interest), r.narration) for r in got.collect()} == {("A", "110.96", "Monthly interest @ 3%"), ("B", "4109.59", "Monthly interest @ 4%")}
    balances, ledger = b.apply_interest(got, F.to_date(F.lit("2026-06-30")), 7)
    assert [(r.txn_id, str(r.running_balance)) for r in ledger.orderBy("txn_id").collect()] == [(7, "45110.96"), (8, "1254109.59")]
    assert balances.count() == 2
