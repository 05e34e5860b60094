"""Format masks of TO_CHAR, TO_DATE and TO_NUMBER, read once and compiled to Spark expressions; an element that can't be said is refused by name."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The elements of date masks, longest first where one begins another.
DATE_ELEMENTS = (
    "SYYYY Y,YYY YYYY RRRR IYYY YYY IYY RR YY IY Y I CC SCC Q MONTH MON MM RM WW IW W DDD DAY DD DY D J HH24 HH12 HH MI SSSSS SS FF1 FF2 FF3 FF4 FF5 FF6 FF7 FF8 FF9 FF "
    "A.M. P.M. AM PM B.C. A.D. BC AD TZH TZM TZR TZD TS DL DS EE E FM FX X"
).split()
_ELEMENT = re.compile("|".join([r'"(?P<quoted>[^"]*)"', "(?P<element>" + "|".join(map(re.escape, sorted(DATE_ELEMENTS, key=len, reverse=True))) + ")(?P<suffix>SPTH|THSP|TH|SP)?", r"(?P<sign>[-/,.;: ])"]), re.I)
_JULIAN_OF_1970 = 2440588


def lexed(mask: str) -> list[tuple[str, str, str]]:
    """(kind, text, suffix): kind is element or literal; texts keep their case."""
    out, at = [], 0
    while at < len(mask):
        m = _ELEMENT.match(mask, at)
        if not m:
            raise ValueError(f"no element of a date mask at {mask[at:]!r}")
        if m["element"]:
            out.append(("element", m["element"], (m["suffix"] or "").upper()))
        else:
            out.append(("literal", m["quoted"] if m["quoted"] is not None else m["sign"], ""))
        at = m.end()
    return out


def _case(value: Column, written: str) -> Column:
    """A word as its element is written: DAY, Day or day."""
    if written[1:2].isupper() or len(written) == 1 and written.isupper():
        return F.upper(value)
    return F.initcap(value) if written[:1].isupper() else F.lower(value)


def _digits(width: int, value: Callable[[Column], Column]):
    return lambda x, fill: F.lpad(value(x).cast("string"), width, "0") if fill else value(x).cast("string")


def _words(pattern: str, width: int):
    return lambda x, fill: F.rpad(F.date_format(x, pattern), width, " ") if fill and width else F.date_format(x, pattern)


def _iso_year(x: Column) -> Column:
    return F.year(F.date_add(x.cast("date"), 3 - F.weekday(x)))


_roman = "I II III IV V VI VII VIII IX X XI XII".split()
#: What an element shows, filled up to its width or not.
SHOWN: dict[str, Callable[[Column, bool], Column]] = {
    "YYYY": _digits(4, F.year), "RRRR": _digits(4, F.year), "YYY": _digits(3, lambda x: F.year(x) % 1000), "YY": _digits(2, lambda x: F.year(x) % 100), "RR": _digits(2, lambda x: F.year(x) % 100), "Y": _digits(1, lambda x: F.year(x) % 10),
    "Y,YYY": lambda x, fill: F.concat(F.floor(F.year(x) / 1000).cast("string"), F.lit(","), F.lpad((F.year(x) % 1000).cast("string"), 3, "0")),
    "IYYY": _digits(4, _iso_year), "IYY": _digits(3, lambda x: _iso_year(x) % 1000), "IY": _digits(2, lambda x: _iso_year(x) % 100), "I": _digits(1, lambda x: _iso_year(x) % 10),
    "CC": _digits(2, lambda x: F.floor((F.year(x) + 99) / 100)), "Q": _digits(1, F.quarter), "MM": _digits(2, F.month), "MON": _words("MMM", 0), "MONTH": _words("MMMM", 9),
    "RM": lambda x, fill: F.rpad(F.get(F.lit(_roman), F.month(x) - 1), 4, " ") if fill else F.get(F.lit(_roman), F.month(x) - 1),
    "WW": _digits(2, lambda x: F.floor((F.dayofyear(x) - 1) / 7) + 1), "IW": _digits(2, F.weekofyear), "W": _digits(1, lambda x: F.floor((F.dayofmonth(x) - 1) / 7) + 1), "DDD": _digits(3, F.dayofyear), "DD": _digits(2, F.dayofmonth),
    "D": _digits(1, F.dayofweek), "DAY": _words("EEEE", 9), "DY": _words("EEE", 0), "J": _digits(7, lambda x: F.datediff(x.cast("date"), F.lit("1970-01-01").cast("date")) + _JULIAN_OF_1970),
    "HH24": _digits(2, F.hour), "HH12": _digits(2, lambda x: (F.hour(x) + 11) % 12 + 1), "HH": _digits(2, lambda x: (F.hour(x) + 11) % 12 + 1), "MI": _digits(2, F.minute), "SS": _digits(2, F.second),
    "SSSSS": _digits(5, lambda x: F.hour(x) * 3600 + F.minute(x) * 60 + F.second(x)), "FF": lambda x, fill: F.date_format(x, "SSSSSS"), **{f"FF{n}": (lambda x, fill, n=n: F.date_format(x, "S" * n)) for n in range(1, 7)},
    "AM": _words("a", 0), "PM": _words("a", 0), "A.M.": lambda x, fill: F.when(F.hour(x) < 12, "A.M.").otherwise("P.M."), "P.M.": lambda x, fill: F.when(F.hour(x) < 12, "A.M.").otherwise("P.M."), "BC": lambda x, fill: F.lit("AD"), "AD": lambda x, fill: F.lit("AD"),
}
_WORDS = {"MON", "MONTH", "DAY", "DY", "RM", "AM", "PM", "A.M.", "P.M.", "BC", "AD"}


def to_char(x: Column, mask: str) -> Column:
    """TO_CHAR of a date or timestamp. Years are those after Christ; FM turns filling off and on."""
    out, fill = [], True
    for kind, text, suffix in lexed(mask):
        name = text.upper()
        if kind == "literal":
            out.append(F.lit(text))
        elif name == "FM":
            fill = not fill
        elif name not in SHOWN or suffix not in ("", "TH"):
            raise ValueError(f"TO_CHAR of {text + suffix} can't be said")
        else:
            shown = SHOWN[name](x, fill and suffix == "")
            if suffix:
                n = shown.cast("int")
                th = F.when((n % 100).between(11, 13), "TH").otherwise(F.get(F.lit(["TH", "ST", "ND", "RD", "TH", "TH", "TH", "TH", "TH", "TH"]), n % 10))
                shown = F.concat(F.lpad(shown, 2, "0") if fill and name in ("DD", "MM") else shown, th if text.isupper() else F.lower(th))
            out.append(_case(shown, text) if name in _WORDS else shown)
    return F.when(x.isNotNull(), F.concat(*out)) if out else F.lit(None).cast("string")


#: What an element reads as a pattern: alone between signs, and next to another number, where it has its full width.
READ = {
    "YYYY": ("yyyy", "yyyy"), "RRRR": ("yyyy", "yyyy"), "YY": ("yy", "yy"), "RR": ("yy", "yy"), "MM": ("M", "MM"), "MON": ("MMM", "MMM"), "MONTH": ("MMMM", "MMMM"), "DD": ("d", "dd"), "DDD": ("D", "DDD"), "HH24": ("H", "HH"), "HH12": ("h", "hh"),
    "HH": ("h", "hh"), "MI": ("m", "mm"), "SS": ("s", "ss"), "FF": ("[SSSSSS][SSSSS][SSSS][SSS][SS][S]", "SSSSSS"), **{f"FF{n}": ("S" * n, "S" * n) for n in range(1, 7)}, "AM": ("a", "a"), "PM": ("a", "a"),
}


def to_timestamp(text: Column, mask: str) -> Column:
    """TO_DATE and TO_TIMESTAMP: null where the text doesn't fit. YY is of this century (2000-2099), RR from 1950 to 2049. Words in any case."""
    tokens = [t for t in lexed(mask) if t[1].upper() not in ("FM", "FX")]
    names = [t[1].upper() if t[0] == "element" else None for t in tokens]
    number = lambda k: 0 <= k < len(names) and names[k] is not None and names[k] not in ("MON", "MONTH", "AM", "PM")
    pattern = []
    for k, (kind, written, suffix) in enumerate(tokens):
        if kind == "literal":
            pattern.append("'" + written.replace("'", "''") + "'" if written.strip() else written)
        elif names[k] not in READ or suffix:
            raise ValueError(f"TO_DATE of {written + suffix} can't be said")
        else:
            pattern.append(READ[names[k]][number(k - 1) or number(k + 1)])
    if "YY" not in "".join(n or "" for n in names) and "RR" not in "".join(n or "" for n in names):
        raise ValueError("TO_DATE without a year can't be said: it would depend on today")
    out = F.try_to_timestamp(F.trim(text), F.lit("".join(pattern)))
    return F.when(F.year(out) >= 2050, F.try_add(out, F.expr("INTERVAL '-100' YEAR"))).otherwise(out) if "RR" in names else out


# -- numbers ------------------------------------------------------------------------------------------------------------------
_NUMBER = re.compile(r"(?P<fm>FM)?(?P<lead>S)?(?P<money>\$)?(?P<whole>[09,G]*)(?:(?P<point>[.D])(?P<part>[09]*))?(?P<tail>S|MI|PR)?", re.I)


def _number_mask(mask: str) -> re.Match:
    m = _NUMBER.fullmatch(mask)
    if not m or not (m["whole"] or m["part"]):
        bad = re.search(r"(?i)EEEE|RN|TM9?|V|X+|[BCLU]", mask)
        raise ValueError(f"a number's mask with {bad[0] if bad else mask!r} can't be said")
    return m


def number_to_char(x: Column, mask: str) -> Column:
    """TO_CHAR of a number: filled to the mask's width with a place for the sign, # where it doesn't fit; FM leaves blanks and trailing zeros of 9s out."""
    m = _number_mask(mask)
    whole, part = m["whole"] or "", m["part"] or ""
    places, width = len(part), sum(c in "09" for c in whole)
    value = F.round(x.cast("decimal(38,10)"), places)
    digits = F.abs(value).cast(f"decimal(38,{places})").cast("string")
    left = F.regexp_replace(F.substring_index(digits, ".", 1), "^0+", "")
    least = len([c for c in whole[whole.index("0"):] if c in "09"]) if "0" in whole else 0
    left = F.when(F.length(left) < least, F.lpad(left, least, "0")).otherwise(left) if least else left
    if not places and not least and width:
        left = F.when(left == "", "0").otherwise(left)
    # Separators stand where the mask has them, counted from the right, as far as there are digits.
    shown, right = F.lit(""), [len([d for d in whole[k + 1 :] if d in "09"]) for k, c in enumerate(whole) if c in ",Gg"]
    cuts = sorted(set(right), reverse=True)
    if cuts:
        pieces, upper = [], None
        for cut in cuts:
            piece = F.substring(left, F.lit(1), F.length(left) - cut) if upper is None else F.right(F.substring(left, F.lit(1), F.length(left) - cut), F.lit(upper - cut))
            pieces.append(F.when(F.length(left) > cut, piece))
            upper = cut
        pieces.append(F.right(left, F.lit(upper)))
        shown = F.concat_ws(",", *pieces)
    else:
        shown = left
    if m["point"]:
        tail = F.right(digits, F.lit(places)) if places else F.lit("")
        if m["fm"]:
            kept = part.rindex("0") + 1 if "0" in part else 0
            tail = F.concat(F.substring(tail, 1, kept), F.regexp_replace(F.substring(tail, kept + 1, 99), "0+$", ""))
        shown = F.concat(shown, F.lit("."), tail)
    if m["money"]:
        shown = F.concat(F.lit("$"), shown)
    below, end = value < 0, (m["tail"] or "").upper()
    if m["lead"]:
        shown, size = F.concat(F.when(below, "-").otherwise("+"), shown), 1
    elif end == "S":
        shown, size = F.concat(shown, F.when(below, "-").otherwise("+")), 1
    elif end == "MI":
        shown, size = F.concat(shown, F.when(below, "-").otherwise("" if m["fm"] else " ")), 1
    elif end == "PR":
        shown, size = F.when(below, F.concat(F.lit("<"), shown, F.lit(">"))).otherwise(shown if m["fm"] else F.concat(shown, F.lit(" "))), 2
    else:
        shown, size = F.concat(F.when(below, "-").otherwise(""), shown), 1
    total = len(whole) + (1 + places if m["point"] else 0) + bool(m["money"]) + size
    over = F.length(F.regexp_replace(F.substring_index(digits, ".", 1), "^0+", "")) > width
    return F.when(x.isNotNull(), F.when(over, F.lit("#" * total)).otherwise(shown if m["fm"] else F.lpad(shown, total, " ")))


def to_number(text: Column, mask: str) -> Column:
    """TO_NUMBER: null where the text doesn't fit the mask; decimal(38, places)."""
    m = _number_mask(mask)
    whole, part = m["whole"] or "", m["part"] or ""
    end = (m["tail"] or "").upper()
    group = r"[,\d]*" if re.search("[,G]", whole, re.I) else r"\d*"
    point = rf"(?:\.\d{{0,{len(part)}}})?" if m["point"] else ""
    sign = {"S": (r"", r"[+-]"), "MI": (r"", r"[- ]?"), "PR": (r"<?", r">?")}.get(end, (r"[+-]" if m["lead"] else r"-?", r""))
    money = r"\$?" if m["money"] else ""
    bare = F.trim(text)
    digits = F.regexp_replace(F.regexp_replace(bare, r"[^0-9.]", ""), r"^$", "x")
    fits = bare.rlike(rf"^{sign[0]}{money}{group}{point}{sign[1]}$") & (F.length(F.regexp_replace(F.substring_index(digits, ".", 1), "^0+", "")) <= sum(c in "09" for c in whole))
    value = digits.try_cast(f"decimal(38,{len(part)})")
    return F.when(fits, F.when(bare.rlike("[-<]"), -value).otherwise(value))
