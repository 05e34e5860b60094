"""Secret scans in DataFrame operations, false positives removed by a random forest.

Candidates are tokens of letters, digits and `_+/=.-!@#$%^&*~` of at least 12 characters, 16 without a telling word near them,
that hold a digit or a known prefix. The forest's features are the candidate's length, its transitions between kinds of
characters, the share that dictionary words cover, its path (slashes, dots, segments that are words, an ending like that of a
file or a domain) and its neighbouring words, two before and two after it. It is trained from labelled findings on the driver (a
bounded sample) and compiled into one SQL expression of nested conditions, so that scanning stays in the engine. No table labels
secrets here: by default the findings are made by rule, and findings of one's own are given to `train`.

Cases: null and empty texts have no findings; a token that occurs several times in a text is a finding each time; repeated
rows repeat their findings; a token may be of any length; an empty table gives no rows; other columns are ignored.
Findings carry a digest of the secret, never the secret.
"""

from __future__ import annotations

import json
import random
import string
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import let

# Words of the dictionary, words that announce a secret or something else, and public key prefixes.
WORDS = (
    "the and for with this that from test example sample demo user name admin root main master server client config file path data base index value key token secret password default local host http https www com org net html json xml image style script page home public private static build release version branch commit merge docker linux windows python java node react table column field string number array object class function method return import export package module library "
    "account address agent alert all app archive article asset auth author auto back block blog body book box browser buffer bucket button cache call card cart category center change channel chart check city cloud code color comment common company content control copy core count country create current date day debug delete deploy design detail device dev dir doc domain download edit email end engine entry error event feature first folder form frame free full game get global graph group guide head header help history icon id info init input install instance item job language last layout level license link list load log login mail make map media member memory menu message meta mobile model name new news note order output owner park photo plan play plugin point policy post price print process product profile project query queue read report request response result role route row run sale search section service session set setup shop site size source space stage start state status store sub support system tab tag task team temp text time title tool topic track type update upload url utils video view web week work world year zone"
).split()
TELLING = "token secret password passwd pwd pass passphrase key apikey api_key access_key secret_key auth authorization bearer credential credentials private_key client_secret".split()
INNOCENT = "commit sha sha1 sha256 md5 checksum digest hash uuid guid id revision etag version example placeholder sample isbn order invoice card phone account".split()
PREFIXES = "AKIA ASIA ghp_ gho_ ghs_ github_pat_ xoxb- xoxp- sk_live_ rk_live_ sk- AIza glpat- npm_ eyJ".split()
FEATURES = ("length", "transitions", "digits", "uppers", "distinct", "marks", "covered", "slashes", "dots", "words", "ending", "address", "hexadecimal", "prefixed", "telling", "innocent")


@dataclass(frozen=True)
class SecretParams:
    trees: int = 15
    depth: int = 5
    least_leaf: int = 8
    seed: int = 17
    least_length: int = 12
    least_length_untold: int = 16
    most_findings: int = 20_000  # labelled findings that the fit may use


class Finding(NamedTuple):
    """A candidate with its neighbouring words, two before and two after it, and 1 if it is a secret."""

    before2: str
    before: str
    token: str
    after: str
    secret: int
    after2: str | None = None


def _word_set(words: list[str]) -> str:
    return "|".join(sorted({w.replace(".", r"\.") for w in words}, key=lambda w: (-len(w), w)))


PREFIXED = f"^([A-Za-z_]+[=:])?({_word_set(PREFIXES)})"


def features(token: Column, before: Column, before2: Column, after: Column, after2: Column) -> Column:
    """The struct of FEATURES of a candidate with the two tokens before and after it."""
    low = F.lower(token)
    count = lambda pattern: F.regexp_count(token, F.lit(pattern)).cast("double")
    near = F.lower(F.concat_ws(" ", before2, before, F.regexp_extract(token, r"^([A-Za-z_]+)[=:]", 1), after, after2))
    n = F.char_length(token).cast("double")
    share = lambda x: x / n
    has = lambda words: near.rlike(rf"(^|[^a-z0-9])({_word_set(words)})([^a-z0-9]|$)").cast("double")
    values = {
        "length": n,
        "transitions": share(count("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]|(?<=[^A-Za-z0-9])[A-Za-z0-9]")),
        "digits": share(count("[0-9]")),
        "uppers": share(count("[A-Z]")),
        "distinct": share(F.size(F.array_distinct(F.split(token, ""))).cast("double")),
        "marks": share(count(r"[!@#$%^&*~]")),
        "covered": share(n - F.char_length(F.regexp_replace(low, _word_set(WORDS), "")).cast("double")),
        "slashes": count("/"),
        "dots": count(r"\."),
        "words": F.regexp_count(low, F.lit(rf"(?<![a-z0-9])({_word_set(WORDS)})(?![a-z])")).cast("double"),
        "ending": token.rlike(r"\.[A-Za-z]{2,5}[0-9]?$").cast("double"),
        "address": token.rlike(r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+\.[A-Za-z.]+$").cast("double"),
        "hexadecimal": token.rlike("^([A-Za-z_]+[=:])?[0-9a-f]+$").cast("double"),
        "prefixed": token.rlike(PREFIXED).cast("double"),
        "telling": has(TELLING),
        "innocent": has(INNOCENT),
    }
    return F.struct(*[values[f].alias(f) for f in FEATURES])


_TOKEN = r"A-Za-z0-9_+/=.\-!@#$%^&*~"


def candidates(docs: DataFrame, p: SecretParams = SecretParams()) -> DataFrame:
    """(doc_id, position, token, f): the tokens that may be secrets, by their number in the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    long_token = f"[{_TOKEN}]{{{p.least_length},}}"
    tokens = F.regexp_extract_all(text, F.lit(f"([{_TOKEN}]+)"), 1)

    def chosen(words: Column) -> Column:
        # Marks at either end are the sentence's, unless the word before is a telling one; they don't count to a token.
        bare = lambda w: F.regexp_replace(w, r"^[.\-!@#$%^&*~/]+|[.,\-!@#$%^&*~]+$", "")
        numbered = F.transform(words, lambda w, i: F.when((F.char_length(w) >= p.least_length) & (w.rlike("[0-9]") | w.rlike(PREFIXED)), i).otherwise(F.lit(-1)))
        sign = lambda i: F.get(words, i).rlike(r"^[=:.\-!@#$%^&*~+/]+$")
        last = lambda i: F.when(sign(i - 1), F.get(words, i - 2)).otherwise(F.get(words, i - 1))
        last2 = lambda i: F.when(sign(i - 1), F.get(words, i - 3)).otherwise(F.get(words, i - 2))
        told = lambda i: F.coalesce(F.lower(last(i)).rlike(rf"(^|[^a-z0-9])({_word_set(TELLING)})([^a-z0-9]|$)"), F.lit(False))
        token = lambda i: F.when(told(i), F.regexp_replace(F.get(words, i), r"^[.\-]+|[.,]+$", "")).otherwise(bare(F.get(words, i)))
        return F.transform(F.filter(numbered, lambda i: i >= 0), lambda i: F.struct(i.alias("position"), token(i).alias("token"), last(i).alias("before"), last2(i).alias("before2"), F.get(words, i + 1).alias("after"), F.get(words, i + 2).alias("after2")))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(text.rlike(long_token), let(tokens, chosen)).alias("found"))
    rows = rows.select("doc_id", F.explode("found").alias("c")).select("doc_id", "c.*").filter(F.char_length("token") >= p.least_length)
    rows = rows.withColumn("f", features(*[F.col(c) for c in ("token", "before", "before2", "after", "after2")]))
    return rows.filter((F.char_length("token") >= p.least_length_untold) | (F.col("f.telling") + F.col("f.prefixed") > 0)).select("doc_id", "position", "token", "f")


def made_findings(n: int = 4000, seed: int = 5) -> list[Finding]:
    """Labelled findings made by rule."""
    r = random.Random(seed)
    some = lambda chars, lo, hi: "".join(r.choice(chars) for _ in range(r.randint(lo, hi)))
    alnum, hexa, b64 = string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_letters + string.digits + "+/"
    plain = "the of in and value was for item node by is to".split()
    out = []
    for k in range(n):
        tell, dull = r.choice(TELLING), r.choice(plain)
        kind, secret = k % 18, 1
        before2, before, after, after2 = r.choice(plain), dull, r.choice(plain), r.choice(plain)
        if kind == 0:
            before, token = tell, some(hexa, 24, 64)
        elif kind == 1:
            before, token = r.choice([*plain, tell]), r.choice(["AKIA", "ASIA"]) + some(string.ascii_uppercase + string.digits, 16, 16)
        elif kind == 2:
            before2, token = tell, some(alnum, 20, 48)
        elif kind == 3:
            before, token = r.choice([tell, dull]), r.choice([p for p in PREFIXES if not p.startswith("A")]) + some(r.choice([alnum, alnum, hexa, "a0"]), 20, 40)
        elif kind == 4:
            token = f"{r.choice(['password', 'secret', 'token', 'key', 'pwd'])}={some(hexa if r.random() < 0.6 else alnum, 14, 40)}"
        elif kind == 5:
            before, token = tell, some(b64, 30, 64) + "=" * r.randint(0, 2)
        elif kind == 6:
            before, token = tell, "".join(r.choice([r.choice(WORDS).capitalize(), some(string.digits, 1, 4), r.choice("!@#$%^&*~")]) for _ in range(9))[:24] + r.choice("!@#$%&") + some(alnum, 4, 6)
        elif kind == 7:
            token = some(alnum, 20, 48)
            after, after2 = r.choice([(tell, after2), (after, tell)])
        elif kind == 8:
            before, token, secret = r.choice(INNOCENT), some(hexa, 32, 64), 0
        elif kind == 9:
            token, secret = r.choice(["", "/", "./"]) + "/".join(r.choice(WORDS) + r.choice(["", "2", "_1"]) for _ in range(r.randint(3, 6))) + r.choice([".html", ".py", ".json", ""]), 0
        elif kind == 10:
            token, secret = some(string.digits, 13, 24), 0
        elif kind == 11:
            before, token, secret = r.choice([tell, dull]), r.choice("_-").join(r.choice(WORDS) for _ in range(r.randint(3, 5))) + r.choice(["123", "1", "_01", "2"]), 0
        elif kind == 12:
            before2 = before = r.choice(["uuid", "id", dull])
            token, secret = "-".join(some(hexa, i, i) for i in (8, 4, 4, 4, 12)), 0
        elif kind == 13:
            token, secret = ".".join([some(string.ascii_lowercase, 3, 9), r.choice(WORDS), f"v{r.randint(1, 9)}", str(r.randint(10, 999))]) + "-" + r.choice(WORDS), 0
        elif kind == 14:
            before, token, secret = r.choice([tell, dull]), f"{some(string.ascii_lowercase, 4, 9)}.{some(string.ascii_lowercase, 3, 8)}{r.randint(1, 99)}@{r.choice(WORDS)}.example.{r.choice(['com', 'org'])}", 0
        elif kind == 15:  # a random name of something in plain prose
            token, secret = some(alnum if r.random() < 0.7 else hexa, 16, 40), 0
        elif kind == 16:  # the same, called a checksum or the like on either side
            token, secret = some(alnum, 16, 48), 0
            before, after, after2 = r.choice([(r.choice(INNOCENT), after, after2), (before, r.choice(INNOCENT), after2), (before, after, r.choice(INNOCENT))])
        else:
            token, secret = "&".join(f"{r.choice(WORDS)}={r.randint(1, 99)}" for _ in range(r.randint(3, 5))), 0
        out.append(Finding(before2, before, token, after, secret, after2))
    return out


class Forest:
    """Trees as nested tuples (feature, cutoff, left, right) or leaf shares."""

    def __init__(self, trees: list):
        self.trees = trees

    @staticmethod
    def fit(rows: list[list[float]], labels: list[int], p: SecretParams = SecretParams()) -> Forest:
        r = random.Random(p.seed)
        some = max(1, round(len(FEATURES) ** 0.5))

        def grow(at: list[int], depth: int):
            share = sum(labels[i] for i in at) / len(at)
            if depth == 0 or share in (0, 1) or len(at) < 2 * p.least_leaf:
                return share
            best = None
            for f in r.sample(range(len(FEATURES)), some):
                order = sorted(at, key=lambda i: rows[i][f])
                ones, total, left = 0, sum(labels[i] for i in at), 0
                for k, i in enumerate(order[:-1]):
                    ones += labels[i]
                    left = k + 1
                    a, b = rows[i][f], rows[order[k + 1]][f]
                    if a == b or left < p.least_leaf or len(at) - left < p.least_leaf:
                        continue
                    x, y = ones / left, (total - ones) / (len(at) - left)
                    gini = left * x * (1 - x) + (len(at) - left) * y * (1 - y)
                    if best is None or gini < best[0]:
                        best = (gini, f, (a + b) / 2)
            if best is None:
                return share
            _, f, cut = best
            low = [i for i in at if rows[i][f] <= cut]
            high = [i for i in at if rows[i][f] > cut]
            return f, cut, grow(low, depth - 1), grow(high, depth - 1)

        n = len(rows)
        return Forest([grow([r.randrange(n) for _ in range(n)], p.depth) for _ in range(p.trees)] if n else [0.0])

    def score(self, row: list[float]) -> float:
        total = 0.0
        for t in self.trees:
            while isinstance(t, tuple):
                t = t[2] if row[t[0]] <= t[1] else t[3]
            total += t
        return total / len(self.trees)

    def column(self, f: Column) -> Column:
        """The mean of the trees over a struct of FEATURES."""

        def of(t) -> Column:
            if not isinstance(t, tuple):
                return F.lit(float(t))
            return F.when(f[FEATURES[t[0]]] <= F.lit(float(t[1])), of(t[2])).otherwise(of(t[3]))

        total = of(self.trees[0])
        for t in self.trees[1:]:
            total = total + of(t)
        return total / F.lit(float(len(self.trees)))


def train(spark: SparkSession, findings: DataFrame | list[Finding] | None = None, p: SecretParams = SecretParams()) -> Forest:
    """A forest of labelled findings; their features are the scan's own expressions.

    Of a table (before2, before, token, after, secret and, if it has one, after2) or a list the fit takes the `most_findings` rows with the
    least hashes. The forest of the findings made by rule is kept for the process.
    """
    if findings is None:
        if p not in _MADE:
            _MADE[p] = train(spark, made_findings(), p)
        return _MADE[p]
    if not isinstance(findings, DataFrame):
        if not findings:
            return Forest([0.0])
        listed = F.from_json(F.lit(json.dumps([r._asdict() for r in findings])), "array<struct<before2: string, before: string, token: string, after: string, secret: int, after2: string>>")
        findings = spark.range(1).select(F.explode(listed).alias("x")).select("x.*")
    after2 = F.col("after2") if "after2" in findings.columns else F.lit(None).cast("string")
    known = findings.filter("token is not null and secret is not null").select("before2", "before", "token", "after", after2.alias("after2"), F.col("secret").cast("int").alias("secret"))
    chosen = known.withColumn("i", F.xxhash64(*known.columns)).orderBy("i").limit(p.most_findings)
    rows = chosen.select("i", "secret", features(*[F.col(c) for c in ("token", "before", "before2", "after", "after2")]).alias("f")).orderBy("i").collect()  # at most most_findings
    return Forest.fit([[r.f[k] for k in FEATURES] for r in rows], [r.secret for r in rows], p)


_MADE: dict[SecretParams, Forest] = {}


def scan_secrets(docs: DataFrame, forest: Forest, p: SecretParams = SecretParams()) -> DataFrame:
    """(doc_id, position, kind, length, digest, score, secret), a row for each candidate."""
    rows = candidates(docs, p)
    token = F.col("token")
    kind = F.when(F.col("f.prefixed") > 0, "prefixed").when(F.col("f.hexadecimal") > 0, "hexadecimal").otherwise("other")
    scored = rows.select("doc_id", F.col("position").cast("long").alias("position"), kind.alias("kind"), F.char_length(token).cast("long").alias("length"), F.sha2(token, 256).alias("digest"), F.round(forest.column(F.col("f")), 6).alias("score"))
    return scored.withColumn("secret", F.col("score") >= 0.5)
