"""Licenses are those of exact containment over all windows; the bands lose almost none."""

import random
import re

from quarrylens.llm import licenses

WORDS = [f"w{k}" for k in range(60)]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_all_windows(text, templates, p=licenses.LicenseParams()):
    out, w = set(), words(text)
    for name, texts in templates.items():
        for t in texts:
            tw = words(t)
            width = min(5, len(tw))
            whole = {tuple(tw[i : i + width]) for i in range(len(tw) - width + 1)}
            shingles = [tuple(w[i : i + width]) for i in range(len(w) - width + 1)] if width < 5 or len(w) >= 5 else [tuple(w)] * bool(w)
            k = max(0, len(whole) - 1).bit_length() if width == 5 else 0
            size, stride = licenses.shape(k)
            if any(len(whole & set(shingles[i : i + size])) >= p.containment * len(whole) for i in range(0, len(shingles), stride)):
                out.add(name)
    return out


def test_scan_is_exact_containment(spark):
    r = random.Random(3)
    made = {f"T{n}": [" ".join(r.choice(WORDS) for _ in range(n))] for n in (1, 2, 4, 5, 6, 7, 9, 13, 20, 21, 37, 40, 69, 120, 260, 600)}
    templates = made | {k: v for k, v in licenses.TEMPLATES.items()}
    texts = [None, "", "x", "... !"]
    for name, (t,) in list(made.items()) + [("MIT", licenses.TEMPLATES["MIT"][-1:]), ("BSD", licenses.TEMPLATES["BSD-2-Clause"][-1:])]:
        w = t.split()
        for edits in (0, 1, len(w) // 40, len(w) // 20):
            v = list(w)
            for _ in range(edits):
                v[r.randrange(len(v))] = "edited"
            texts.append(" ".join([*(r.choice(WORDS) for _ in range(r.randint(0, 300))), *v, *(r.choice(WORDS) for _ in range(r.randint(0, 300)))]))
    texts += texts[5:7]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, licenses string")
    got = {x.doc_id: set(x.licenses.split(",")) - {""} for x in licenses.scan_licenses(docs, templates).collect()}
    want = [by_all_windows(t, templates) for t in texts]
    assert all(got[i] == want[i] for i in range(len(texts))), [(i, got[i] ^ want[i]) for i in range(len(texts)) if got[i] != want[i]]
    assert sum(map(len, want)) > 100
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_bands_promise_what_they_say():
    p = licenses.LicenseParams()
    for k in range(1, 14):
        m = (1 << (k - 1)) + 1
        held = -(-8 * m // 10)
        j = held / (licenses.shape(k)[0] + m - held)
        assert 1 - (1 - j) ** licenses.bands_of(k, p) >= p.meets
    assert licenses.bands_of(0, p) == 1
