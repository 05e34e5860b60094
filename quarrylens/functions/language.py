"""Identifiers, conditions, types and prose of a code base in a reader's words, as column expressions.

A condition is cut into tokens once; each token is reworded on its own, so inserted words are never reworded again and quoted
literals stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Written-out abbreviations (no ordinary words), operators in words, the forms of provenance in prose.
ABBREVIATIONS = {"Acct": "Account", "Amt": "Amount", "Txn": "Transaction", "Bal": "Balance", "Req": "Required", "Cust": "Customer", "Ref": "Reference", "Num": "Number", "Min": "Minimum", "Max": "Maximum", "Dt": "Date", "Emi": "Instalment", "Pct": "Percent"}
OPERATORS = {"<=": "is at most", ">=": "is at least", "<>": "is not", "!=": "is not", "^=": "is not", "<": "is below", ">": "is above", "=": "is", ":=": "becomes", "IS NULL": "is missing", "IS NOT NULL": "is present", "IN": "is one of", "NOT IN": "is none of", "AND": "and", "OR": "or", "NOT": "not", "BETWEEN": "is between"}
PROVENANCE = (r"\s*\b(?:Implemented|Defined|Declared)\s+in\s+\S+,\s*line\s+\d+\.?", r"\s*\([A-Z]{3,6}-[^()]*,\s*line\s+\d+\)")
#: What must not reach a reader: statement numbers, nested scopes, file prints.
INTERNAL = r"STMT_\d+|NESTED_BLOCK#\d+|__[0-9A-F]{8}|(?:IF|LOOP|CASE)#\d+"
#: Quoted literals and names as they stand (1), or a name after its prefix (2).
_PREFIXED = r"(?is)('[^']*'|(?![pvlge]_)[a-z_][\w$#]*(?:\.[a-z_][\w$#]*)*)|[pvlge]_([\w$#]*(?:\.[a-z_][\w$#]*)*)"
_TOKEN = r"(?is)'[^']*'|\bIS\s+NOT\s+NULL\b|\bIS\s+NULL\b|\bNOT\s+IN\b|[a-z_][\w$#]*(?:\.[a-z_][\w$#]*)*|:=|<=|>=|<>|!=|\^=|[<>=]|\s+|."


def written_out(words: Column) -> Column:
    """Abbreviations as whole words; words without any are looked at once only."""
    out = words
    for short, long in ABBREVIATIONS.items():
        out = F.regexp_replace(out, rf"\b{short}\b", long)
    return F.when(words.rlike(rf"\b(?:{'|'.join(ABBREVIATIONS)})\b"), out).otherwise(words)


def humanise(identifier: Column) -> Column:
    """`p_from_account` -> From Account; qualifiers and the prefixes of parameters, variables and exceptions go."""
    last = F.regexp_replace(F.lower(F.element_at(F.split(identifier, r"\."), -1)), "^(p|v|l|g|e|c|in|out)_(?=[a-z])", "")
    return written_out(F.initcap(F.trim(F.regexp_replace(last, "[_$#]+", " "))))


def object_title(object_id: Column) -> Column:
    """`PROC-.SP_TRANSFER_FUNDS` -> Transfer Funds."""
    return humanise(title_part(object_id))


def title_part(object_id: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(object_id, r"([^.:]+)$", 1), "(?i)^(sp|fn|pkg|prc|trg|vw)_", "")


def _tokens(text: Column, word) -> Column:
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), word), "")


def _is_name(token: Column) -> Column:
    return token.rlike(r"^[A-Za-z_]") & token.rlike(r"[_.]")


def humanise_identifiers(text: Column) -> Column:
    """Only words with `_` or `.` are identifiers; ordinary words and quoted literals stay."""
    return _tokens(text, lambda t: F.when(_is_name(t), humanise(t)).otherwise(t))


def humanise_condition(condition: Column) -> Column:
    """`v_from_balance < p_amount` -> From Balance is below Amount."""
    pairs = F.create_map(*[F.lit(x) for kv in OPERATORS.items() for x in kv])

    def word(t: Column) -> Column:
        said = F.try_element_at(pairs, F.regexp_replace(F.upper(t), r"\s+", " "))
        return F.when(t.startswith("'"), t).when(said.isNotNull(), F.concat(F.lit(" "), said, F.lit(" "))).when(_is_name(t), humanise(t)).otherwise(t)

    spaced = F.trim(F.regexp_replace(_tokens(condition, word), r"\s+(?=(?:[^']*'[^']*')*[^']*$)", " "))
    return F.regexp_replace(F.regexp_replace(spaced, r"\( ", "("), r" \)", ")")


def unwrapped(text: Column) -> Column:
    """Without a pair of parentheses that encloses the whole; those of a call stay."""
    bare = F.regexp_replace(text, "'[^']*'", "")
    inner = F.filter(F.split(F.substring(bare, F.lit(2), F.length(bare) - 2), ""), lambda c: c.isin("(", ")"))
    depth = F.aggregate(inner, F.struct(F.lit(0).alias("d"), F.lit(0).alias("low")), lambda a, c: F.struct((a["d"] + F.when(c == "(", 1).otherwise(-1)).alias("d"), F.least(a["low"], a["d"] + F.when(c == "(", 1).otherwise(-1)).alias("low")))
    whole = bare.startswith("(") & bare.endswith(")") & (depth["d"] == 0) & (depth["low"] == 0)
    # Most texts have no such pair, and for these nothing is counted.
    return F.when(text.startswith("(") & text.endswith(")") & whole, F.trim(F.substring(text, F.lit(2), F.length(text) - 2))).otherwise(text)


def short_condition(condition: Column) -> Column:
    """A condition for a figure: one line, without the enclosing pair and the variables' prefixes."""
    flat = unwrapped(F.trim(F.regexp_replace(condition, r"\s+", " ")))
    return F.regexp_replace(flat, _PREFIXED, "$1$2")


def humanise_description(text: Column) -> Column:
    """Prose without where it came from, identifiers in words."""
    for form in PROVENANCE:
        text = F.regexp_replace(text, form, "")
    return humanise_identifiers(text)


def plain_type(declared: Column) -> Column:
    """`NUMBER(18,2)` -> Decimal number (18 digits, 2 decimal places)."""
    base, size, scale = F.upper(F.regexp_extract(declared, r"^\s*(\w+)", 1)), F.regexp_extract(declared, r"\(\s*(\d+)", 1), F.regexp_extract(declared, r",\s*(-?\d+)", 1)
    number = base.isin("NUMBER", "DECIMAL", "NUMERIC", "DEC")
    return (
        F.when(number & (size == ""), "Number").when(number & scale.isin("", "0"), F.concat(F.lit("Whole number ("), size, F.lit(" digits)"))).when(number, F.concat(F.lit("Decimal number ("), size, F.lit(" digits, "), scale, F.lit(" decimal places)")))
        .when(base.isin("INTEGER", "INT", "SMALLINT", "PLS_INTEGER", "BINARY_INTEGER"), "Whole number").when(base.isin("FLOAT", "REAL", "BINARY_FLOAT", "BINARY_DOUBLE"), "Floating-point number")
        .when(base.isin("VARCHAR2", "VARCHAR", "CHAR", "NVARCHAR2", "NCHAR") & (size != ""), F.concat(F.lit("Text (up to "), size, F.lit(" characters)"))).when(base.isin("VARCHAR2", "VARCHAR", "CHAR", "NVARCHAR2", "NCHAR"), "Text").when(base.isin("CLOB", "NCLOB", "LONG"), "Long text")
        .when(base.isin("DATE", "TIMESTAMP"), "Date and time").when(base == "BOOLEAN", "Yes or no").when(base.isin("BLOB", "RAW"), "Binary data").otherwise(F.initcap(declared))
    )


def anchor(heading: Column) -> Column:
    """The link target that a Markdown reader makes of a heading."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(heading)), r"[^\w\s-]", ""), r"\s", "-")
