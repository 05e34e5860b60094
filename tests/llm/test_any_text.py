"""Surrogates of texts in any script: nothing ends a job, every entity that is found is replaced, time grows with length."""

import random
import time

from quarrylens.llm import pii

DIGITS = ["0123456789", "٠١٢٣٤٥٦٧٨٩", "०१२३४५६७८९", "０１２３４５６７８９", "𝟎𝟏𝟐𝟑𝟒𝟓𝟔𝟕𝟖𝟗", "²³¹①"]
WORDS = ["Mary", "O'Neil", "O’Neil", "Mr", "Dr.", "张三", "Иван", "Петров", "Ὀδυσσεύς", "محمد", "דוד", "İstanbul", "ß", "Çelik", "straße", "ǅ", "ﬁ", "my name is", "@", "@x.org", "ü@ü.de", "::", ":", ".", "-", "+", "(0)", " ", "\n", "DE", "IBAN", "ffff", "\ud800", "\x00", "é", "👩‍👩‍👧"]


def random_text(rnd):
    out = []
    for _ in range(rnd.randrange(1, 9)):
        kind, d = rnd.randrange(9), rnd.choice(DIGITS)
        digits = lambda n: "".join(rnd.choice(rnd.choice(DIGITS) if rnd.random() < 0.1 else d) for _ in range(n))  # noqa: E731, B023
        out.append(
            [
                lambda: ".".join(digits(rnd.randrange(1, 4)) for _ in range(4)), lambda: "+" + digits(rnd.randrange(7, 16)), lambda: f"+1 {digits(3)} {digits(3)} {digits(4)}", lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
                lambda: digits(rnd.randrange(12, 20)), lambda: rnd.choice(["DE", "GB", "FR"]) + digits(2) + digits(rnd.randrange(11, 31)), lambda: "".join(rnd.choice(WORDS) for _ in range(3)) + "@" + rnd.choice(["a.de", "mail.example.com"]),
                lambda: ":".join(rnd.choice(["", "1", "ffff", "2001", "db8", "0"]) for _ in range(rnd.randrange(2, 9))) + rnd.choice(["", ":1.2.3.4"]), lambda: " ".join(rnd.choice(WORDS) for _ in range(4)),
            ][kind]()
        )
    return rnd.choice([" ", "", ", "]).join(out)


def test_nothing_raises_and_all_change():
    s, rnd = pii.Surrogates(), random.Random(1)
    for _ in range(25_000):
        text = random_text(rnd)
        new, counts = s.scrub(text)
        plain = pii._ascii_digits(text)
        found = s.finds(plain)
        assert bool(found) == bool(counts)
        for lo, hi, kind in found:
            made = s.of(kind, plain[lo:hi])
            assert made != plain[lo:hi] or not any(pii._class_of(c.lower(), pii._PLAIN) for c in plain[lo:hi] if len(c.lower()) == 1), (kind, plain[lo:hi])


def test_writings():
    s = pii.Surrogates()
    one = lambda t: s.scrub(t)[0]
    western, arabic = one("call +1 415 555 2671"), one("call +1 415 555 ٢٦٧١")
    assert western != "call +1 415 555 2671" and pii._ascii_digits(arabic) == western and any("٠" <= c <= "٩" for c in arabic)
    assert one("host 1.٣.٣.٣ here") != "host 1.٣.٣.٣ here" and one("１.1.1.1") != "１.1.1.1"
    plain = one("at 1.2.3.4 now").split()[1]
    assert one("at ::ffff:1.2.3.4 now") == f"at ::ffff:{plain} now"
    for name in ("Mary O'Neil", "Mary O’Neil"):
        new = one(f"{name} called")
        assert new != f"{name} called" and new[new.index(" ") + 2] == name[6] and "Neil" not in new
    assert not one("write to 张三@example.com").startswith("write to 张三@")
    assert all("ß" not in one(f"Herr Ç{x}elik kam") for x in "abcdefgh")


def test_time_is_linear():
    s, text = pii.Surrogates(), "host 1.٣.٣.٣ +1 415 555 ٢٦٧١ Mary O'Neil ::ffff:1.2.3.4 张三@example.com "
    took = []
    for n in (2_000, 8_000):
        began = time.process_time()
        s.scrub(text * n)
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 0.5
