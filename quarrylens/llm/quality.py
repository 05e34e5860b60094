"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Each rule is a share computed from a text; higher is worse. A fixed path tightens the rules one step at a time, so that what a
step rejects holds all that the steps before it reject. Symbols come first, over their whole grid, as prose has next to none; the other
rules then take turns from mild to strict. For each stratum (language) the labelled rows of good quality are the holdout: a step
holds if the exact binomial probability of so few of them rejected, were the true rate of false rejection by all rules
together `risk`, is at most the level. The tests stop at the first step that fails (fixed sequence), so a path needs no further correction;
Bonferroni divides the level by the number of strata. The stratum takes the cutoffs of its last step that holds; if none does, only the base
rules reject. The strata that count are those with the good rows that a single stratum would need; the others are left out before
counts reach the driver, so at most (labelled rows / that number) do. Their number depends on no rejection.

Cases: a null text has no words and fails the base rules; a null language is a stratum of its own; a document is good if
the least of its labels is 1; null labels and labels without a document don't count; without labels only the base rules
reject. Repeated rows are judged alike. Other columns are ignored by `judge` and kept by `keep_quality`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE, Scratch, let, space_words

#: Rules and what they divide, as numerator and denominator; with a cutoff c a text is rejected if numerator > c/1000 * denominator.
RULES = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"), "capitals": ("n_capitals", "word_chars")}
#: Cutoffs in thousandths, from mild to strict.
GRID = (600, 500, 400, 300, 250, 200, 150, 100, 80, 60, 50, 40, 30, 20)
#: The steps in the order of their tests: a rule and its new cutoff.
PATH = tuple([("symbols", c) for c in GRID] + [(rule, c) for c in GRID for rule in ("dup_lines", "repeats", "capitals")])


@dataclass(frozen=True)
class QualityParams:
    """risk: the share of good texts (of those that pass the base rules) that all rules of a stratum together may reject; the bounds of all strata hold at once with probability 1 - level."""

    risk: float = 0.02
    level: float = 0.05

    def rows_needed(self, strata: int) -> int:
        """Good rows with which a step that rejects none of them holds."""
        return math.ceil(math.log(self.level / strata) / math.log1p(-self.risk))


def repeat_words(words: Column, size: int = 5) -> Column:
    """Words that lie in a window of `size` words found twice or more in the list, the first included."""

    def of(hashes: Column) -> Column:
        n = F.size(hashes) - size + 1
        codes = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(*[F.element_at(hashes, (i + k).cast("int")) for k in range(size)]))
        return F.when(n < 2, F.lit(0)).otherwise(let(codes, windows))

    def windows(codes: Column) -> Column:
        return F.when(F.size(F.array_distinct(codes)) == F.size(codes), F.lit(0)).otherwise(covered(codes))

    def covered(codes: Column) -> Column:
        placed = F.array_sort(F.transform(codes, lambda c, i: F.struct(c.alias("c"), i.alias("i"))))
        return let(placed, lambda s: marked(F.array_sort(F.filter(F.transform(s, lambda x, j: F.when(twin(s, x, j), x["i"]).otherwise(F.lit(-1))), lambda i: i >= 0))))

    def twin(s: Column, x: Column, j: Column) -> Column:
        before = (j > 0) & (F.get(s, j - 1)["c"] == x["c"])
        return F.coalesce(before, F.lit(False)) | F.coalesce(F.get(s, j + 1)["c"] == x["c"], F.lit(False))

    def marked(at: Column) -> Column:
        """Starts in order: each adds the words up to the next start, `size` at most."""
        start = F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last"))
        return F.aggregate(at, start, lambda a, i: F.struct((a["n"] + F.least(F.lit(size), i - a["last"])).alias("n"), i.alias("last")))["n"]

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def counts(text: Column) -> Column:
    """A struct of the counts of a text, by the white-space word rule."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    by_word = let(
        space_words(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.char_length(F.concat_ws("", w)).cast("long").alias("word_chars"), repeat_words(w).cast("long").alias("n_repeat_words")),
    )
    by_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols, capitals = (F.regexp_count(text, F.lit(x)).cast("long") for x in ("[#*$%&|<>]", "[A-Z]"))
    return let(
        F.struct(by_word.alias("w"), by_line.alias("l"), symbols.alias("s"), capitals.alias("c")),
        lambda x: F.struct(
            x["w"]["n_words"].alias("n_words"), x["w"]["word_chars"].alias("word_chars"), x["s"].alias("n_symbols"), x["l"]["n_dup_lines"].alias("n_dup_lines"), x["w"]["n_repeat_words"].alias("n_repeat_words"), x["c"].alias("n_capitals"), x["l"]["n_lines"].alias("n_lines")
        ),
    )


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def fails(m: Column, rule: str, cutoff: int) -> Column:
    a, b = RULES[rule]
    return F.lit(1000) * m[a] > F.lit(cutoff) * m[b]


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang and m, the counts of the text, for each row of docs."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), counts(F.col("text")).alias("m"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial, as the regularised incomplete beta function I(1 - p; n - k, k + 1) by its continued fraction."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1, 1 - p
    if x > (a + 1) / (a + b + 2):  # the fraction converges fast below this point, the other tail beyond it
        return 1.0 - _beta(b, a, p)
    return _beta(a, b, x)


def _beta(a: float, b: float, x: float) -> float:
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    out = d
    for m in range(1, 100_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 / ((1 + step * d) or tiny), (1 + step / c) or tiny
            out *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * out


def first_step(m: Column) -> Column:
    """The number, from 1, of the path's first step that rejects the text; one more than the last if none does."""
    of_rule = []
    for rule in RULES:
        steps = [(k, c) for k, (r, c) in enumerate(PATH, 1) if r == rule]
        found = F.when(fails(m, rule, steps[0][1]), steps[0][0])
        for k, c in steps[1:]:
            found = found.when(fails(m, rule, c), k)
        of_rule.append(found.otherwise(len(PATH) + 1))
    return F.least(*of_rule)


def cutoffs(measured: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> dict[str | None, dict[str, int]]:
    """For each stratum in which a step holds, the cutoffs of the last that does."""
    good = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("doc_id is not null and quality is not null")
    good = good.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1").select("doc_id")
    rows = measured.join(good, "doc_id", "left_semi").filter(~base_failed(F.col("m")))
    counted = rows.groupBy("lang", first_step(F.col("m")).alias("step")).agg(F.count("*").alias("x"))
    strata = counted.groupBy("lang").agg(F.sum("x").alias("n"), F.map_from_entries(F.collect_list(F.struct("step", "x"))).alias("x"))
    found = strata.filter(F.col("n") >= params.rows_needed(1)).collect()
    out: dict[str | None, dict[str, int]] = {}
    for r in found:
        rejected = 0
        for k, (rule, c) in enumerate(PATH, 1):
            rejected += r["x"].get(k, 0)
            if binomial_tail(rejected, r["n"], params.risk) > params.level / len(found):
                break
            out.setdefault(r["lang"], {})[rule] = c
    return out


def kept(m: Column, lang: Column, limits: dict[str | None, dict[str, int]]) -> Column:
    """Neither the base rules nor a cutoff of the row's stratum reject it."""
    out, strata = ~base_failed(m), {}
    for stratum, rules in limits.items():
        for rule, c in rules.items():
            strata.setdefault((rule, c), []).append(stratum)
    for (rule, c), names in strata.items():  # a term for each cutoff, however many strata there are
        inside = F.coalesce(lang.isin([x for x in names if x is not None]), F.lit(False))
        out = out & ~((inside | lang.isNull() if None in names else inside) & fails(m, rule, c))
    return out


def judge(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """doc_id, lang, the counts, base_failed and kept, a row for each row of docs."""
    measured = Scratch(docs.sparkSession).table(measures(docs), "measured")
    limits, m = cutoffs(measured, labels, params), F.col("m")
    return measured.select("doc_id", "lang", "m.*", base_failed(m).alias("base_failed"), kept(m, F.col("lang"), limits).alias("kept"))


def keep_quality(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """The rows of docs that are kept, with all their columns, whatever their names.

    Rows are written once with their counts, so that no text is measured twice or shuffled.
    """
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), counts(F.col("text")).alias("m"))
    whole = Scratch(docs.sparkSession).table(whole, "whole")
    limits = cutoffs(whole, labels, params)
    return whole.filter(kept(F.col("m"), F.col("lang"), limits)).select("row.*")
