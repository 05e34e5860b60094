"""Every language with enough labels gets cutoffs, however many there are; a stratum stops where its own test fails."""

from pyspark.sql import functions as F

from quarrylens.llm import quality


def test_more_languages_than_the_least_divisor(spark):
    good = " ".join("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split())
    docs = spark.range(25 * 900).select(F.col("id").alias("doc_id"), F.lit(good).alias("text"), F.when(F.col("id") % 25 > 0, F.concat(F.lit("l"), F.col("id") % 25)).alias("lang"))
    junk = spark.range(25).select((F.col("id") + 10**6).alias("doc_id"), F.lit(good + "#" * 200).alias("text"), F.when(F.col("id") > 0, F.concat(F.lit("l"), "id")).alias("lang"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    limits = quality.cutoffs(quality.measures(docs), labels)
    assert len(limits) == 25 and None in limits and all(x["symbols"] == quality.GRID[-1] for x in limits.values())
    assert quality.keep_quality(docs.unionByName(junk), labels).count() == 25 * 900
    # 300 good rows are enough for 20 strata but not for the 25 that are tested.
    assert quality.cutoffs(quality.measures(docs), labels.filter("doc_id < 25 * 300")) == {}
    few = "doc_id % 25 < 20 and doc_id < 25 * 300"
    assert len(quality.cutoffs(quality.measures(docs), labels.filter(few))) == 20


def test_a_stratum_stops_at_its_first_step_that_fails(spark):
    """Two languages with 400 good rows each: in one of them 5 % have a third of capitals, so that no stricter cutoff of capitals holds there."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    i = F.col("id")
    loud = (i % 2 == 1) & (i % 40 == 1)
    text = F.when(loud, F.regexp_replace(F.lit(words), "[aeiou]", "A")).otherwise(F.lit(words))
    docs = spark.range(800).select(i.alias("doc_id"), text.alias("text"), F.when(i % 2 == 1, "b").otherwise("a").alias("lang"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    limits = quality.cutoffs(quality.measures(docs), labels)
    assert set(limits["a"].values()) == {quality.GRID[-1]}
    share = docs.filter("lang = 'b'").select(quality.counts(F.col("text")).alias("m")).selectExpr("max(1000 * m.n_capitals / m.word_chars) as x").first().x
    assert limits["b"]["symbols"] == quality.GRID[-1] and limits["b"]["capitals"] == min(c for c in quality.GRID if c >= share)
    assert quality.keep_quality(docs, labels).count() == 800


def test_steps_are_nested():
    last = {}
    for rule, c in quality.PATH:
        assert c < last.get(rule, 10**6)
        last[rule] = c
    assert last == dict.fromkeys(quality.RULES, quality.GRID[-1])
