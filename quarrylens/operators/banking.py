"""The analysed routines as set-based jobs: one pass over a table instead of one call for each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.cut import row_numbers
from ..functions.oracle import concat_nulls, days_between, dec_round, greatest, least, money, number_text, trunc_day

# Fixed values of the routines.
MIN_BALANCE = {"SAVINGS_REGULAR": 1000, "SAVINGS_PREMIUM": 10000, "SAVINGS_ZERO_BAL": 0, "CURRENT_REGULAR": 5000, "CURRENT_PREMIUM": 25000}
SLABS = ((100_000, "3.0"), (1_000_000, "3.5"), (10_000_000, "4.0"), (None, "4.5"))
DORMANT_AFTER_DAYS = 365
VELOCITY_LIMIT = 6
MOST_SLABS = 10_000


def simple_interest(principal: Column, rate: Column, days: Column, basis: Column) -> tuple[Column, Column]:
    """Interest and error code: -20001 for the principal, -20002 for the rate, -20003 for the days; null without an error."""
    error = F.when(principal.isNull() | (principal < 0), -20001).when(rate.isNull() | (rate < 0), -20002).when(days.isNull() | (days < 0), -20003)
    year = F.when(basis == "360", 360).otherwise(365)
    exact = principal.cast("decimal(18,2)") * rate.cast("decimal(8,4)") * days.cast("decimal(6,0)") / (F.lit(100) * year)
    return F.when(error.isNull(), dec_round(exact)), error


def dormancy(status: Column, last: Column, as_of: Column) -> tuple[Column, Column]:
    """(new status, outcome); a null status is an account that wasn't found."""
    days = F.coalesce(days_between(as_of, last), F.lit(9999))
    to_dormant, to_active = (status == "ACTIVE") & (days > DORMANT_AFTER_DAYS), (status == "DORMANT") & (days <= DORMANT_AFTER_DAYS)
    new = F.when(to_dormant, "DORMANT").when(to_active, "ACTIVE").otherwise(status)
    outcome = F.when(status.isNull(), "ACCOUNT_NOT_FOUND").when(to_dormant, "MARKED_DORMANT").when(to_active, "REACTIVATED").otherwise("NO_STATUS_CHANGE_REQUIRED")
    return new, outcome


def minimum_balance(kind: Column) -> Column:
    out = F.when(F.lit(False), 0)
    for name, least_ in MIN_BALANCE.items():
        out = out.when(kind == name, least_)
    return out.otherwise(1000)


def minimum_balance_check(balance: Column, kind: Column) -> tuple[Column, Column, Column]:
    """(shortfall, penalty, outcome). A null balance passes, as a comparison with null is not true."""
    needed = minimum_balance(kind)
    below = F.coalesce(balance < needed, F.lit(False))
    shortfall = F.when(below, money(needed - balance)).otherwise(money(F.lit(0)))
    penalty = money(least(money(F.lit(500)), greatest(money(F.lit(50)), dec_round(shortfall * F.lit("0.05").cast("decimal(3,2)")))))
    return shortfall, F.when(below, penalty).otherwise(money(F.lit(0))), F.when(below, "BELOW_MINIMUM_BALANCE").otherwise("BALANCE_OK")


def slab_rate(balance: Column) -> Column:
    out = None
    for top, rate in SLABS[:-1]:
        out = F.when(balance < top, F.lit(rate)) if out is None else out.when(balance < top, F.lit(rate))
    return out.otherwise(F.lit(SLABS[-1][1])).cast("decimal(6,3)")


def monthly_interest(accounts: DataFrame, run_date: Column) -> DataFrame:
    """account_number, balance, rate, interest, narration for eligible accounts; only interest above zero is credited."""
    days = F.dayofmonth(F.last_day(run_date))
    rate, balance = slab_rate(F.col("balance")), money(F.col("balance"))
    eligible = accounts.filter((F.col("account_status") == "ACTIVE") & F.col("account_type").like("SAVINGS%"))
    exact = balance.cast("decimal(24,2)") * rate * days / F.lit(36500)
    out = eligible.select("account_number", balance.alias("balance"), rate.alias("rate"), dec_round(exact).alias("interest"))
    note = concat_nulls(F.lit("Monthly interest @ "), number_text(F.col("rate")), F.lit("%"))
    return out.filter("interest > 0").withColumn("narration", note)


def apply_interest(credits: DataFrame, run_date: Column, first_id: int = 1) -> tuple[DataFrame, DataFrame]:
    """(new balances, ledger rows) of one run, ids in order of account number."""
    after = credits.withColumn("balance", money(F.col("balance") + F.col("interest")))
    number = F.col("number") + F.lit(first_id - 1)
    ledger = row_numbers(after, [F.asc("account_number")]).select(number.alias("txn_id"), "account_number", run_date.alias("txn_date"), F.lit("INTEREST_CREDIT").alias("txn_type"), F.col("interest").alias("txn_amount"), F.col("balance").alias("running_balance"), "narration")
    return after.select("account_number", "balance"), ledger


def split_failures(rows: DataFrame, checked: Column, key: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows by an expression that is null where it failed: one bad row doesn't end the batch."""
    tagged = rows.withColumn("checked", checked)
    return tagged.filter("checked is not null"), tagged.filter("checked is null").select(F.col(key).cast("string").alias("entity_key"), F.lit("value can't be used").alias("error_message"))


def transfer_outcome(amount: Column, source: Column, target: Column, source_status: Column, target_status: Column, balance: Column, limit: Column, sent_today: Column) -> Column:
    """The first check that fails, in the routine's order; comparisons with null don't fail."""
    return (
        F.when(amount.isNull() | (amount <= 0), "INVALID_AMOUNT")
        .when(source == target, "SAME_ACCOUNT")
        .when(source_status.isNull(), "SOURCE_NOT_FOUND")
        .when(source_status != "ACTIVE", "SOURCE_NOT_ACTIVE")
        .when(target_status.isNull(), "TARGET_NOT_FOUND")
        .when(target_status != "ACTIVE", "TARGET_NOT_ACTIVE")
        .when(balance < amount, "INSUFFICIENT_BALANCE")
        .when(sent_today + amount > limit, "DAILY_LIMIT_EXCEEDED")
        .otherwise("SUCCESS")
    )


def running_daily_total(rows: DataFrame, account: str, ts: str, amount: str, key: str) -> DataFrame:
    """What an account has sent on the same day before each row."""
    w = Window.partitionBy(account, trunc_day(F.col(ts))).orderBy(ts, key).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("sent_today", F.coalesce(F.sum(amount).over(w), money(F.lit(0))))


def double_entry(transfers: DataFrame, source: str, target: str, amount: str, key: str) -> DataFrame:
    """Two ledger rows for each transfer with the running balance of each account after it."""
    legs = F.array(F.struct(F.col(source).alias("account"), (-F.col(amount)).alias("amount"), F.lit("TRANSFER_OUT").alias("txn_type")), F.struct(F.col(target).alias("account"), F.col(amount).alias("amount"), F.lit("TRANSFER_IN").alias("txn_type")))
    rows = transfers.select(key, F.explode(legs).alias("leg")).select(key, "leg.*")
    w = Window.partitionBy("account").orderBy(key, "txn_type").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("running_balance", F.sum("amount").over(w))


def statement(ledger: DataFrame, account: str, order: list[str], amount: str) -> DataFrame:
    """Ledger history with a running balance."""
    w = Window.partitionBy(account).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ledger.withColumn("running_balance", F.sum(amount).over(w))


def range_lookup(rows: DataFrame, value: str, slabs: DataFrame) -> DataFrame:
    """Rows with the slab lo <= value <= hi that holds them; a null hi is open. slabs is a rate table of at most MOST_SLABS rows, which is checked, and is broadcast."""
    if slabs.limit(MOST_SLABS + 1).count() > MOST_SLABS:
        raise ValueError(f"a rate table has at most {MOST_SLABS} slabs")
    return rows.join(F.broadcast(slabs), (F.col(value) >= F.col("lo")) & (F.col("hi").isNull() | (F.col(value) <= F.col("hi"))), "left")


def rate_in_force(rows: DataFrame, keys: list[str], at: str, rates: DataFrame, effective: str, rate: str) -> DataFrame:
    """As-of join without a range join: both sides are united and the last rate before each row is carried down."""
    left = rows.select("*", F.lit(1).alias("_side"), F.lit(None).cast(rates.schema[rate].dataType).alias("_rate"), F.col(at).alias("_at"))
    right = rates.select(*keys, F.lit(0).alias("_side"), F.col(rate).alias("_rate"), F.col(effective).alias("_at"))
    w = Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = left.unionByName(right, allowMissingColumns=True).withColumn(rate, F.last("_rate", ignorenulls=True).over(w))
    return both.filter("_side = 1").drop("_side", "_rate", "_at")


def amortization_with_resets(loans: DataFrame, key: str, principal: str, yearly_rate: str, months: str, resets: DataFrame) -> DataFrame:
    """A row for each instalment of floating loans; resets: (key, effective_installment_no, revised_annual_rate).

    From a reset on, the level instalment is that of the balance and the months then left. A loan's stretches of one rate, a few,
    are folded in order; the instalments of a stretch follow from its opening balance in closed form.
    """
    n = F.col(months).cast("int")
    listed = resets.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col("effective_installment_no").cast("int").alias("start"), F.col("revised_annual_rate").cast("double").alias("rate")))).alias("later"))
    rows = loans.join(listed, key, "left")
    first = F.array(F.struct(F.lit(1).alias("start"), F.col(yearly_rate).cast("double").alias("rate")))
    all_ = F.concat(first, F.coalesce(F.filter("later", lambda x: (x["start"] > 1) & (x["start"] <= n)), F.array().cast("array<struct<start:int,rate:double>>")))
    ends = F.transform(all_, lambda x, i: F.struct(x["start"].alias("start"), (x["rate"] / 1200).alias("r"), (F.coalesce(F.get(all_, i + 1)["start"], n + 1) - x["start"]).alias("long")))

    def level(balance: Column, r: Column, left: Column) -> Column:
        return F.when(r == 0, balance / left).otherwise(balance * r * F.pow(1 + r, left) / (F.pow(1 + r, left) - 1))

    def after(balance: Column, r: Column, emi: Column, k: Column) -> Column:
        return F.when(r == 0, balance - emi * k).otherwise(balance * F.pow(1 + r, k) - emi * (F.pow(1 + r, k) - 1) / r)

    def fold(acc: Column, x: Column) -> Column:
        emi = level(acc["balance"], x["r"], n - x["start"] + 1)
        part = F.struct(x["start"].alias("start"), x["long"].alias("long"), x["r"].alias("r"), acc["balance"].alias("opening"), emi.alias("emi"))
        return F.struct(after(acc["balance"], x["r"], emi, x["long"]).alias("balance"), F.concat(acc["parts"], F.array(part)).alias("parts"))

    empty = F.array().cast("array<struct<start:int,long:int,r:double,opening:double,emi:double>>")
    parts = F.aggregate(ends, F.struct(F.col(principal).cast("double").alias("balance"), empty.alias("parts")), fold)["parts"]
    rows = rows.select(key, F.explode(parts).alias("s")).select(key, "s.*").select("*", F.explode(F.sequence(F.lit(0), F.col("long") - 1)).alias("k"))
    opening, closing = (after(F.col("opening"), F.col("r"), F.col("emi"), k) for k in (F.col("k"), F.col("k") + 1))
    interest = opening * F.col("r")
    return rows.select(key, (F.col("start") + F.col("k")).alias("installment_no"), *[dec_round(x).alias(c) for c, x in (("opening_balance", opening), ("emi_amount", F.col("emi")), ("interest_component", interest), ("principal_component", F.col("emi") - interest), ("closing_balance", closing))])


def accrue(accounts: DataFrame, rates: DataFrame, days: DataFrame, holidays: DataFrame) -> DataFrame:
    """(account_number, accrual_date, accrued_amount, applied_rate) for each account and day that is no holiday.

    rates: (product_code, min_balance, max_balance, annual_rate, effective_date); in force is the latest effective rate of the slab that
    holds the balance. days and holidays are calendars of days and rates a rate table, all checked to be small and broadcast.
    """
    open_days = days.join(holidays.select(F.col("holiday_date").alias("day")), "day", "left_anti")
    for small in (open_days, rates):
        if small.limit(MOST_SLABS + 1).count() > MOST_SLABS:
            raise ValueError(f"calendars and rate tables have at most {MOST_SLABS} rows")
    r = F.broadcast(rates.alias("r"))
    slab = (F.col("a.product_code") == F.col("r.product_code")) & (F.col("a.balance") >= F.col("r.min_balance")) & (F.col("r.max_balance").isNull() | (F.col("a.balance") <= F.col("r.max_balance")))
    known = accounts.alias("a").join(r, slab).groupBy("a.account_number", "a.balance").agg(F.collect_list(F.struct("r.effective_date", "r.annual_rate")).alias("in_force"))
    daily = known.join(F.broadcast(open_days), F.exists("in_force", lambda x: x["effective_date"] <= F.col("day")))
    rate = F.array_max(F.filter("in_force", lambda x: x["effective_date"] <= F.col("day")))["annual_rate"]
    amount = F.col("balance").cast("decimal(18,2)") * rate.cast("decimal(6,3)") / F.lit(36500)
    return daily.select("account_number", F.col("day").alias("accrual_date"), dec_round(amount, 4).alias("accrued_amount"), rate.alias("applied_rate"))


def provisioning(loans: DataFrame, shares: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(loans with provisioning_amount by their classification, the control total by quarter_end_date). shares: percent of the outstanding principal."""
    share = F.element_at(F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]), F.col("classification")).cast("decimal(6,2)")
    each = loans.withColumn("provisioning_amount", dec_round(F.col("outstanding_principal").cast("decimal(18,2)") * share / F.lit(100)))
    total = each.groupBy(F.last_day(F.add_months(F.trunc("classification_date", "quarter"), 2)).alias("quarter_end_date")).agg(F.count(F.lit(1)).alias("total_accounts"), F.sum("provisioning_amount").cast("decimal(20,2)").alias("total_provisioning_amount"))
    return each, total


def geo_mismatch(registered: Column, origin: Column) -> Column:
    """A transaction from another country than the account's; an unknown country is none."""
    return F.coalesce(registered != origin, F.lit(False))


def change_balances(accounts: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """accounts after all changes (key, amount), credits above and debits below zero; a written row's null balance becomes 0, as its trigger has it."""
    sums = changes.groupBy(key).agg(F.sum("amount").alias("change"))
    changed = F.col("change").isNotNull()
    new = F.coalesce(F.col("balance") + F.col("change"), F.lit(0))
    return accounts.join(sums, key, "left").withColumn("balance", F.when(changed, new).otherwise(F.col("balance")).cast("decimal(20,2)")).drop("change")


def register_claims(claims: DataFrame, contracts: DataFrame, first_id: int = 1) -> tuple[DataFrame, DataFrame]:
    """(each claim's outcome, the registered claims with ids in order of claim_id). claims: claim_id, contract_id, amount; contracts: contract_id, contract_status."""
    seen = claims.join(contracts.select("contract_id", "contract_status", F.lit(True).alias("there")), "contract_id", "left")
    outcome = F.when(F.col("there").isNull(), "CONTRACT_NOT_FOUND").when(F.col("contract_status") != "ACTIVE", "CONTRACT_NOT_ACTIVE").otherwise("CLAIM_REGISTERED")
    judged = seen.select("claim_id", "contract_id", "amount", outcome.alias("outcome"))
    ok = row_numbers(judged.filter("outcome = 'CLAIM_REGISTERED'"), [F.asc("claim_id")])
    return judged.select("claim_id", "outcome"), ok.select((F.col("number") + first_id - 1).alias("registered_id"), "claim_id", "contract_id", "amount", F.lit("OPEN").alias("claim_status"))


def npa_bucket(days_past_due: Column, restructured_on: Column, as_of: Column) -> Column:
    """Bucket by days past due; a loan restructured within twelve months is special mention at least."""
    bucket = F.when(days_past_due <= 0, "STANDARD").when(days_past_due <= 90, "SPECIAL_MENTION").when(days_past_due <= 365, "SUBSTANDARD").when(days_past_due <= 1095, "DOUBTFUL").otherwise("LOSS")
    return F.when((bucket == "STANDARD") & (F.add_months(restructured_on, 12) >= as_of), "SPECIAL_MENTION").otherwise(bucket)


# Fixed order of the buckets, from good to bad.
BUCKETS = ("STANDARD", "SPECIAL_MENTION", "SUBSTANDARD", "DOUBTFUL", "LOSS")


def movement(bucket: Column, before: Column) -> Column:
    place = lambda x: F.array_position(F.lit(list(BUCKETS)), x)
    return F.when(before.isNull(), "NEW").when(before == bucket, "UNCHANGED").when(place(bucket) < place(before), "UPGRADED").otherwise("DOWNGRADED")
