"""Tokens of any length, and known prefixes without a digit."""

import base64
import json
import random
import string

from quarrylens.llm import secrets


def test_long_and_prefixed_tokens_are_judged(spark):
    r = random.Random(11)
    part = lambda x: base64.urlsafe_b64encode(x).decode().rstrip("=")
    claims = json.dumps({f"claim{i}": "".join(r.choice(string.ascii_letters) for _ in range(20)) for i in range(30)}).encode()
    jwt = f'{part(json.dumps({"alg": "RS256", "typ": "JWT"}).encode())}.{part(claims)}.{part(r.randbytes(256))}'
    key = base64.b64encode(r.randbytes(1200)).decode()
    letters = "".join(r.choice(string.ascii_letters) for _ in range(36))
    texts = [f"Authorization Bearer {jwt} end", f"private_key = {key}", f"use ghp_{letters} here", f"token sk-{letters} end", f"x token=ghp_{letters} y", f"plain {letters} text"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in secrets.scan_secrets(docs, secrets.train(spark)).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4] and len(jwt) > 512
    assert got[0].length == len(jwt) and got[1].length == len(key) and all(got[i].kind == "prefixed" for i in (0, 2, 3, 4))
    assert all(x.secret for x in got.values())
