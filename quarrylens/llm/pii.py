"""Personal data: detection and keyed surrogates.

E-mail and IP addresses, telephone numbers, card and other long numbers, social security numbers, IBANs and names of persons
are replaced by others of their type. An entity is first brought to a normal form, which doesn't depend on its writing: a
telephone number is its country code and national number (ten digits without a code are read with code 1), a name is each of
its parts in lower case. A surrogate is the image of the normal form under a keyed permutation of the normal forms of its
kind, put back into the writing it was found in: separators stay, letters stay letters of the same script and case, given
names keep gender and script, cards their first digit and check digit, addresses their range. Hence the same entity has the
same surrogate everywhere, and two entities never share one. This is checked for each new surrogate: it is read again as it
is written, must have the normal form that was meant, differ from the original's, and lead back to it under the inverse. An entity
that fails a check, or can't be read by its kind's rules, gets a keyed form of its own writing instead, which may meet another's; it never ends a job.
Digits of other scripts are read by their values and written back in their script; letters of scripts without a class of their own
are permuted among their neighbours; an IPv4 address inside an IPv6 one has the surrogate of that address.

Names are found by a known given name (a list, which a parameter extends) and a surname, in either order and in capitals,
after a title (Mr, Frau, Mme ...), and after words that announce one ("my name is"). Parts of a name are permuted each on
their own and, once a name is found in a text, its surname and given name are also replaced where they stand alone in that
text. So "Mary Smith ... Mr Smith ... Mary" stay one person. A lone name that no such sign announces is not found.

Cases: null stays null and empty stays empty; texts without an entity come back unchanged, byte for byte; overlapping
finds are resolved from left to right, the longest first; repeated rows get the same text; a text is searched in time
proportional to its length; all columns of the input are kept; counts take underscores where the input has their names.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b
from ipaddress import IPv4Address, IPv6Address, ip_address

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .common import small_batches

# Given names by script and gender.
GIVEN = {
    ("latin", "male"): "James John Robert Michael William David Richard Joseph Thomas Charles Christopher Matthew Anthony Steven Andrew Kenneth George Joshua Kevin Brian Edward Ronald Timothy Jason Jeffrey Jürgen Klaus Wolfgang Günter Dieter Stefan Pierre Jacques François Philippe Laurent José Carlos Miguel Javier Francisco Alejandro Ahmed Mohammed Rahul Arjun Wei".split(),
    ("latin", "female"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Margaret Sandra Ashley Kimberly Emily Michelle Carol Amanda Melissa Deborah Ursula Monika Sabine Gabriele Brigitte Heike Nathalie Isabelle Sylvie Véronique Camille María Carmen Lucía Pilar Mercedes Dolores Fatima Aisha Priya Anjali Mei".split(),
    ("cyrillic", "male"): "Иван Сергей Дмитрий Алексей Николай Владимир Михаил Андрей Павел Юрий".split(),
    ("cyrillic", "female"): "Анна Ольга Мария Елена Наталья Татьяна Ирина Светлана Екатерина Людмила".split(),
}
# Titles before a name, and words that announce a name of two words.
TITLES = "Mr Mrs Ms Miss Dr Prof Sir Herr Frau Monsieur Madame Mme Mlle Señor Señora Sr Sra Don Doña господин госпожа".split()
ANNOUNCED = ("my name is", "full name:", "name:", "contact person:", "signed by", "sincerely,", "kind regards,", "best regards,", "mein Name ist", "je m'appelle", "me llamo", "меня зовут")
# Country codes of two digits; 1 and 7 have one, all others three.
TWO_DIGIT_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())

TYPES = ("email", "iban", "ip", "ssn", "number", "phone", "name")
_UPPER, _LOW = "A-ZÀ-ÖØ-ÞА-ЯЁ", "a-zß-öø-ÿа-яё"
_PART = rf"(?:[{_UPPER}]['’])?[{_UPPER}](?:[{_LOW}]+|[{_UPPER}]+(?![{_LOW}]))(?:['’-][{_UPPER}][{_LOW}{_UPPER}]+)?|Mc[A-Z][a-z]+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Everything with a fixed beginning; runs are bounded, so that no long token is read again and again.
_FIND = re.compile(
    r"(?<![A-Za-z0-9])(?P<iban>[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?))(?![A-Za-z0-9])"
    rf"|(?<![\d.])(?P<ip>{_OCTET}(?:\.{_OCTET}){{3}})(?![\d]|\.\d)"
    r"|(?<![\w:.])(?P<ip6>(?=[0-9A-Fa-f:]{2,39}(?![\w:]|\.\d))[0-9A-Fa-f]{0,4}:[0-9A-Fa-f:]*:[0-9A-Fa-f]{0,4})"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?<![A-Za-z0-9])(?P<number>\d{13,19}|\d{4}(?:[ \-]\d{4}){2,3}(?:[ \-]\d{1,4})?|\d{4}[ \-]\d{6}[ \-]\d{5})(?![A-Za-z0-9])"
    r"|(?<![\w+])(?P<phone>\+[1-9](?:[ .\-/()]{0,2}\d){7,14}|1[ .\-](?:\([2-9]\d{2}\)[ .\-]?|[2-9]\d{2}[ .\-])\d{3}[ .\-]\d{4}|(?:\(\d{2,4}\)[ .\-]?|\d{2,4}[ .\-])\d{3,4}[ .\-]\d{3,4}|0\d{2,4}[ /\-]\d{5,8}|[2-9]\d{2}[2-9]\d{6})(?![\w-])"
)
_MAYBE, _SPACE = re.compile(r"[0-9]|::"), re.compile(r"\s")
_GOES_ON = re.compile(r"\s[A-Z]{1,4}(?!\S)|\s[^\s0-9]{0,8}[0-9]\S*")
_LOCAL = re.compile(r"[\w.%+\-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}")
_MOST_LOCAL = 64  # characters before an "@", as the mail standard bounds them
_CAPITALS = re.compile(rf"(?<!\w)([{_UPPER}][{_LOW}{_UPPER}]+)(?= (?:[{_UPPER}]\. )?[{_UPPER}])")
_AFTER = re.compile(rf" (?:(?P<initial>[{_UPPER}])\. )?(?P<surname>{_PART})(?!\w)")
_TITLED = re.compile(rf"(?<!\w)(?:{'|'.join(TITLES)})\.? (?:(?P<given>{_PART}) )?(?:(?P<initial>[{_UPPER}])\. )?(?P<surname>{_PART})(?!\w)")
_REVERSED = re.compile(rf"(?:^|(?<=[\n;:(\t|]))[ ]*(?P<surname>{_PART}), (?P<given>{_PART})(?: (?P<initial>[{_UPPER}])\.)?(?=[ ]*(?:$|[\n;)\t|]))")
_ANNOUNCED = re.compile(rf"(?i:(?<!\w)(?:{'|'.join(map(re.escape, ANNOUNCED))}))\s{{1,2}}(?P<given>{_PART}) (?:(?P<initial>[{_UPPER}])\. )?(?P<surname>{_PART})(?!\w)")
_TITLE_SIGN = re.compile("|".join(map(re.escape, TITLES)))
_ANNOUNCE_SIGN = re.compile("|".join(sorted({re.escape(a.split()[-1].lower().rstrip(":,")) for a in ANNOUNCED})), re.I)


def _stretches(text: str):
    """Stretches of words with a digit or "::" and what may go on from them."""
    at = 0
    while m := _MAYBE.search(text, at):
        lo = m.start()
        while lo > at and not text[lo - 1].isspace():
            lo -= 1
        end = _SPACE.search(text, m.end())
        hi = end.start() if end else len(text)
        while more := _GOES_ON.match(text, hi):
            hi = more.end()
        yield lo, hi
        at = hi


def _emails(text: str):
    """Start and end of each address: from an "@" to the left, at most as far as the last address, and to the right."""
    at = text.find("@")
    last = 0
    while at >= 0:
        if m := _DOMAIN.match(text, at):
            lo = at
            while lo > max(last, at - _MOST_LOCAL) and _LOCAL.match(text[lo - 1]):
                lo -= 1
            while lo < at and not text[lo].isalnum():
                lo += 1
            if lo < at:
                yield lo, m.end()
                last = at = m.end() - 1
        at = text.find("@", at + 1)


@dataclass(frozen=True)
class PiiParams:
    key: str = "surrogates"  # the secret; whoever knows it can invert surrogates
    rounds: int = 8
    given: tuple[str, ...] = ()  # further given names, of unknown gender


class Permutation:
    """A keyed permutation of 0..n-1: a balanced Feistel network, walked until it lands below n."""

    def __init__(self, key: bytes, rounds: int):
        self.key, self.rounds = key, rounds

    def _round(self, k: int, half: int, bits: int, tweak: str) -> int:
        h = blake2b(f"{k}|{bits}|{half}|{tweak}".encode(), key=self.key, digest_size=16).digest()
        return int.from_bytes(h, "big") & ((1 << bits) - 1)

    def _walk(self, x: int, n: int, tweak: str, back: bool) -> int:
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        bits += bits % 2 if bits > 64 else 0
        tweak = f"{n}|{tweak}"
        while True:
            a, b = x >> bits, x & ((1 << bits) - 1)
            for k in reversed(range(self.rounds)) if back else range(self.rounds):
                if back:
                    a, b = b ^ self._wide(k, a, bits, tweak), a
                else:
                    a, b = b, a ^ self._wide(k, b, bits, tweak)
            x = a << bits | b
            if x < n:
                return x

    def _wide(self, k: int, half: int, bits: int, tweak: str) -> int:
        if bits <= 128:
            return self._round(k, half, bits, tweak)
        out, got = 0, 0
        while got < bits:
            out, got = out << 128 | self._round(k, half, 128, f"{got}|{tweak}"), got + 128
        return out & ((1 << bits) - 1)

    def forward(self, x: int, n: int, tweak: str) -> int:
        """No x below n stays where it is, unless n is 1: x and its neighbour x ^ 1 swap images if either would."""
        if n == 1:
            return 0
        if n == 2:
            return 1 - x
        if n % 2 and x >= n - 3:
            return n - 3 + (x - (n - 3) + 1 + self._round(0, 0, 8, f"{n}|{tweak}") % 2) % 3
        m = n - 3 if n % 2 else n
        if m == 2:
            return 1 - x
        y, z = self._walk(x, m, tweak, False), self._walk(x ^ 1, m, tweak, False)
        return z if y == x or z == x ^ 1 else y

    def inverse(self, y: int, n: int, tweak: str) -> int:
        if n == 1:
            return 0
        if n == 2:
            return 1 - y
        if n % 2 and y >= n - 3:
            return n - 3 + (y - (n - 3) - 1 - self._round(0, 0, 8, f"{n}|{tweak}") % 2) % 3
        m = n - 3 if n % 2 else n
        if m == 2:
            return 1 - y
        x = self._walk(y, m, tweak, True)
        image, partner = self._walk(x, m, tweak, False), self._walk(x ^ 1, m, tweak, False)
        return x ^ 1 if image == x or partner == x ^ 1 else x


#: Letters that a surrogate's letters come from, by what the original's are: vowels and consonants of each script.
_CLASSES = ["aeiou", "bcdfghjklmnpqrstvwxyz", "äöüàáâãåæèéêëìíîïòóôõøùúûý", "çñðþ", "аеиоуыэюяё", "бвгджзклмнпрстфхцчшщ", "0123456789"]
_CLASS = {c: s for s in _CLASSES for c in s}


@lru_cache(maxsize=4096)
def _neighbours(c: str) -> str:
    """Letters that stand for a letter of another script: those of its kind and case among 256 code points."""
    first, kind = ord(c) & ~0xFF, unicodedata.category(c)
    return "".join(x for x in map(chr, range(first, first + 256)) if x.isalpha() and unicodedata.category(x) == kind and x.lower() == x and len(x.upper()) == 1 and x not in _CLASS)


def _class_of(c: str, classes: dict[str, str]) -> str | None:
    if found := classes.get(c):
        return found
    if c > "\x7f" and c.isalpha() and c in (near := _neighbours(c)):
        return near
    return None


_OTHER_DIGIT = re.compile(r"(?![0-9])\d")


def _ascii_digits(text: str) -> str:
    """text with the decimal digits of all scripts as 0-9, character for character."""
    if text.isascii() or not _OTHER_DIGIT.search(text):
        return text
    return _OTHER_DIGIT.sub(lambda m: str(unicodedata.decimal(m[0])), text)


def _digits_as_in(new: str, old: str) -> str:
    """new with the digits of old's script, if that isn't 0-9."""
    other = _OTHER_DIGIT.search(old)
    if not other:
        return new
    zero = ord(other[0]) - unicodedata.decimal(other[0])
    return re.sub("[0-9]", lambda m: chr(zero + int(m[0])), new)


def _numeral(text: str, classes: dict[str, str] = _CLASS) -> tuple[int, int]:
    """The number that a lower-case text is among the texts of its form, and their number."""
    value, size = 0, 1
    for c in text:
        if s := _class_of(c, classes):
            value, size = value * len(s) + s.index(c), size * len(s)
    return value, size


def _spelled(value: int, form: str, classes: dict[str, str] = _CLASS) -> str:
    out = []
    for c in reversed(form):
        if s := _class_of(c, classes):
            value, k = divmod(value, len(s))
            c = s[k]
        out.append(c)
    return "".join(reversed(out))


def _ascii_classes() -> dict[str, str]:
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    return _CLASS | {c: letters for c in letters} | {c: digits for c in digits}


_PLAIN = _ascii_classes()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _lowered(text: str) -> str:
    return "".join(low if len(low := c.lower()) == 1 else c for c in text)


def _cased(new: str, old: str) -> str:
    return "".join(up if o.isupper() and len(up := n.upper()) == 1 else n for n, o in zip(new, old, strict=True))


def phone_parts(text: str) -> tuple[str, str]:
    """Country code and national number. Without a code: 1 for ten digits, or eleven that begin with 1, else none."""
    digits = re.sub(r"\D", "", re.sub(r"\(0\)", "", text) if text[0] == "+" else text)
    if text[0] != "+":
        return ("1", digits[-10:]) if len(digits) == 10 or (len(digits) == 11 and digits[0] == "1") else ("", digits)
    n = 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGIT_CODES else 3
    return digits[:n], digits[n:]


_ENDING = re.compile(r"(?:ова|ева|ина|ская|ов|ев|ин|ский)$")


def _split_surname(name: str) -> tuple[str, str]:
    """A lower-case surname's stem and, of Slavic ones, the ending that tells the gender."""
    e = _ENDING.search(name, 1)
    return (name[: e.start()], e[0]) if e else (name, "")


#: Ranges of addresses that keep to themselves: value of the leading bits, their number, and the bits of an address.
_RANGES = {
    32: ((10, 8), (127, 8), (0xAC1, 12), (0xC0A8, 16), (0xA9FE, 16)),
    128: ((0, 96), (0xFFFF, 96), (0x3FA, 10), (0x7E, 7), (0xFF, 8)),
}


def _in_range(value: int, bits: int) -> tuple[int, int]:
    """The special range of an address, else (-1, 0), for which IPv6 keeps the first three bits."""
    return next(((lead, n) for lead, n in _RANGES[bits] if value >> (bits - n) == lead), (-1, 0))


class Surrogates:
    """Keyed replacements of entities; a worker keeps those it has made."""

    def __init__(self, p: PiiParams = PiiParams()):
        self.p = p
        self._made = None

    def __getstate__(self):
        return {"p": self.p, "_made": None}

    def _ready(self):
        if self._made is None:
            self._permutation = Permutation(blake2b(self.p.key.encode(), digest_size=32).digest(), self.p.rounds)
            self._pools = {n.lower(): [x.lower() for x in names] for names in GIVEN.values() for n in names}
            self._known = frozenset(self._pools) | {n.lower() for n in self.p.given}
            self._made = lru_cache(maxsize=50_000)(self._make)

    def of(self, kind: str, text: str) -> str:
        self._ready()
        return self._made(kind, text)

    def _permuted(self, form: str, tweak: str, classes=_CLASS, valid=lambda s: True) -> str:
        """The image of a text among those of its form that are valid or not as it is; checked by the way back."""
        value, n = _numeral(form, classes)
        side = valid(form)
        x = value
        while True:
            y = self._permutation.forward(x, n, tweak)
            if self._permutation.inverse(y, n, tweak) != x:
                raise ValueError("a surrogate doesn't lead back to its entity")
            out = _spelled(y, form, classes)
            if valid(out) == side and (y != value or n <= 1):
                return out
            if y == value:  # it came full circle: no other text of the form is valid alike
                return out
            x = y

    @staticmethod
    def _into(shape: str, characters: str) -> str:
        """Letters and digits of shape replaced in turn, in shape's case."""
        it = iter(characters)
        return "".join((n.upper() if c.isupper() else n) if c.isalnum() and (n := next(it)) else c for c in shape)

    def _make(self, kind: str, text: str) -> str:
        """An entity's surrogate. What can't be brought to a normal form, or fails a check, gets a keyed form: no text ends a job or keeps an entity."""
        try:
            new = getattr(self, f"_{kind}")(text)
        except Exception:  # whatever a text may hold that its kind's rules don't foresee
            new = text
        return self._keyed(kind, text) if new == text else new

    def _keyed(self, kind: str, text: str) -> str:
        """Each letter and digit moved on by a keyed number of places among its like, never by none."""
        out = []
        for k, c in enumerate(text):
            low = c.lower() if len(c.lower()) == 1 else c
            if (s := _class_of(low, _PLAIN)) and len(s) > 1:
                step = 1 + int.from_bytes(blake2b(f"{kind}|{k}|{text}".encode("utf-8", "replace"), key=self._permutation.key, digest_size=8).digest(), "big") % (len(s) - 1)
                new = s[(s.index(low) + step) % len(s)]
                c = new.upper() if c != low and len(new.upper()) == 1 else new
            out.append(c)
        return "".join(out)

    def _checked(self, normal, meant, new: str) -> str:
        """new, if it reads as what was meant."""
        if normal(new) != meant:
            raise ValueError("a surrogate doesn't read as the entity that was meant")
        return new

    def _email(self, text: str) -> str:
        normal = lambda t: tuple(_lowered(x) for x in (*t.rpartition("@")[::2],))
        local, domain = normal(text)
        name, _, top = domain.rpartition(".")
        new = (self._permuted(local, f"local|{domain}", _PLAIN), f"{self._permuted(name, 'domain', _PLAIN)}.{top}")
        return self._checked(normal, new, _cased(f"{new[0]}@{new[1]}", text))

    def _iban(self, text: str) -> str:
        normal = lambda t: re.sub(r"[^A-Z0-9]", "", t).lower()
        plain = normal(text)
        country, check, rest = plain[:2], plain[2:4], plain[4:]
        value = lambda r, c: int("".join(str(int(x, 36)) for x in r + country + c))
        if value(rest, check) % 97 == 1:
            new = self._permuted(rest, f"iban|{country}", _PLAIN)
            check = f"{98 - value(new, '00') % 97:02d}"
        else:  # numbers with a wrong check stay among those
            new = self._permuted(rest, f"iban|{country}|{check}", _PLAIN, lambda r: value(r, check) % 97 == 1)
        return self._checked(normal, country + check + new, self._into(text, country + check + new))

    def _address(self, value: int, bits: int) -> int:
        lead, n = _in_range(value, bits)
        fixed, keep = (lead, n) if n else (value >> (bits - 3), 3) if bits == 128 else (0, 0)
        free = bits - keep
        y = value & ((1 << free) - 1)
        while True:
            y = self._permutation.forward(y, 1 << free, f"ip|{bits}|{fixed}|{keep}")
            new = fixed << free | y
            if _in_range(new, bits) == (lead, n):
                return new

    def _ip(self, text: str) -> str:
        normal = lambda t: int(ip_address(t))
        new = self._address(normal(text), 32)
        return self._checked(normal, new, str(IPv4Address(new)))

    def _ip6(self, text: str) -> str:
        normal = lambda t: int(IPv6Address(t))
        new = self._address(normal(text), 128)
        written = IPv6Address(new).compressed if "::" in text else ":".join(f"{new >> s & 0xFFFF:{'04x' if re.search('(?:^|:)0', text) else 'x'}}" for s in range(112, -1, -16))
        return self._checked(normal, new, written.upper() if text.upper() == text and text.lower() != text else written)

    def _ssn(self, text: str) -> str:
        return self._into(text, self._permuted(text.replace("-", ""), "ssn", _PLAIN, lambda s: s[0] != "9" and s[:3] not in ("000", "666")))

    def _phone(self, text: str) -> str:
        code, rest = phone_parts(text)
        valid = (lambda s: s[0] not in "01") if code == "1" else (lambda s: s[0] != "0")
        new = self._permuted(rest, f"phone|{code}", _PLAIN, valid)
        shape = re.sub(r"\(0\)", "(\0)", text) if text[0] == "+" else text  # a trunk zero is no digit of the number
        prefix = code if text[0] == "+" or len(re.sub(r"\D", "", text)) == 11 and code else ""
        return self._checked(phone_parts, (code, new), self._into(shape, prefix + new).replace("\0", "0"))

    def _number(self, text: str) -> str:
        digits = re.sub(r"\D", "", text)
        first = digits[0]  # of cards, the kind of issuer
        new = first + self._permuted(digits[1:], f"number|{first}", _PLAIN, lambda s: luhn(first + s))
        return self._checked(lambda t: re.sub(r"\D", "", t), new, self._into(text, new))

    def _forename(self, text: str) -> str:
        """A known given name becomes another of its gender and script; an unknown one stays unknown and keeps a last vowel."""
        name = _lowered(text)
        if pool := self._pools.get(name):
            new = pool[self._permutation.forward(pool.index(name), len(pool), f"given|{pool[0]}")]
            return new.upper() if text.isupper() and len(text) > 1 else new.capitalize()
        end = name[-1] if name[-1] in "aeoаяио" and len(name) > 2 else ""
        stem = name[: len(name) - len(end)]
        keeps = lambda s: s + end in self._pools or bool(not end and s[-1] in "aeoаяио" and len(s) > 2)
        return _cased(self._permuted(stem, f"forename|{end}", valid=keeps) + end, text)

    def _initial(self, text: str) -> str:
        return _cased(self._permuted(_lowered(text), "initial", _PLAIN), text)

    def _surname(self, text: str) -> str:
        stem, ending = _split_surname(_lowered(text))
        new = self._permuted(stem, f"surname|{ending}", valid=lambda s: _split_surname(s + ending) == (s, ending)) + ending
        return self._checked(lambda t: _split_surname(_lowered(t)), (new[: len(new) - len(ending)], ending), _cased(new, text))

    def names(self, text: str) -> list[tuple[int, int, str]]:
        """The parts of names: start, end and which part."""
        self._ready()
        found: dict[tuple[int, int], str] = {}

        def take(m, given=None):
            for part in ("given", "initial", "surname"):
                if part in m.re.groupindex and m[part] is not None:
                    found[m.span(part)] = "forename" if part == "given" else part
            if given:
                found[given] = "forename"

        for c in _CAPITALS.finditer(text):
            if c[1].lower() in self._known and (m := _AFTER.match(text, c.end())) and m["surname"].lower() not in self._known:
                take(m, c.span())
        if _TITLE_SIGN.search(text):
            for m in _TITLED.finditer(text):
                take(m)
        if _ANNOUNCE_SIGN.search(text):
            for m in _ANNOUNCED.finditer(text):
                take(m)
        if ", " in text:
            for m in _REVERSED.finditer(text):
                if m["given"].lower() in self._known:
                    take(m)
        if not found:
            return []
        # The same person's parts, wherever they stand alone in this text.
        parts = {text[lo:hi].lower(): kind for (lo, hi), kind in found.items() if kind != "initial"}
        parts |= {text[lo:hi].lower(): kind for (lo, hi), kind in found.items() if kind == "surname"}
        for m in _WORDS.finditer(text):
            if (kind := parts.get(m[0].lower())) and m.span() not in found:
                found[m.span()] = kind
        return sorted((lo, hi, kind) for (lo, hi), kind in found.items())

    def finds(self, text: str) -> list[tuple[int, int, str]]:
        """Start, end and type of each entity or part of a name, in order and without overlaps."""
        out = [(lo, hi, "email") for lo, hi in _emails(text)] if "@" in text else []
        for lo, hi in _stretches(text):
            for m in _FIND.finditer(text, lo, hi):
                if m.lastgroup != "ip6" or _is_ip6(m[0]):
                    out.append((*m.span(m.lastgroup), m.lastgroup))
        out += self.names(text)
        merged: list[tuple[int, int, str]] = []
        for f in sorted(out, key=lambda f: (f[0], -f[1])):
            if not merged or f[0] >= merged[-1][1]:
                merged.append(f)
        return merged

    def scrub(self, text: str | None) -> tuple[str | None, dict[str, int]]:
        """The text with surrogates and the number of finds of each type; a whole name counts once, by its surname or lone part."""
        counts: dict[str, int] = {}
        if not text:
            return text, counts
        plain = _ascii_digits(text)
        if not (found := self.finds(plain)):
            return text, counts
        parts, at, was = [], 0, None
        for lo, hi, kind in found:
            parts += [text[at:lo], _digits_as_in(self.of(kind, plain[lo:hi]), text[lo:hi])]
            name = kind in ("forename", "initial", "surname")
            if not (name and was is not None and text[at:lo] in (" ", ", ", ". ")):
                counted = "name" if name else "ip" if kind == "ip6" else kind
                counts[counted] = counts.get(counted, 0) + 1
            was, at = kind if name else None, hi
        return "".join([*parts, text[at:]]), counts


_WORDS = re.compile(rf"(?<!\w)[{_UPPER}][{_LOW}{_UPPER}'’-]*[{_LOW}{_UPPER}](?!\w)")


def _is_ip6(text: str) -> bool:
    try:
        IPv6Address(text)
    except ValueError:
        return False
    return any(c != ":" for c in text)


def scrub(docs: DataFrame, params: PiiParams = PiiParams(), with_counts: bool = False) -> DataFrame:
    """docs with `text` scrubbed, all columns kept; with_counts adds n_<type> columns at the end."""
    small_batches(docs.sparkSession)
    made, at = Surrogates(params), docs.columns.index("text")
    added = []
    for k in TYPES if with_counts else ():
        name = f"n_{k}"
        while name in (*docs.columns, *added):
            name += "_"
        added.append(name)

    def run(batches):
        for batch in batches:
            texts, counts = [], []
            for t in batch.column(at).to_pylist():
                new, found = made.scrub(t)
                texts.append(new)
                counts.append(found)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.column(at).type)
            if with_counts:
                columns += [pa.array([c.get(k, 0) for c in counts], pa.int64()) for k in TYPES]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added])

    schema = T.StructType(docs.schema.fields + [T.StructField(name, T.LongType()) for name in added])
    return docs.mapInArrow(run, schema)
