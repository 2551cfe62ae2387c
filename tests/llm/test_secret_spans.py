"""Operator 6: every span by brute force, and what the method may not depend on."""

import math
import re
import string
import time
from collections import Counter

import pytest
from llm_helpers import words
from pyspark.sql import functions as F

from wikisift.llm import secret_scan as S

SPACE = "\x20\t\n\x0b\x0c\r"


def entropy(s):
    best = 0.0
    for a in range(len(s) - S.WINDOW + 1):
        n = Counter(s[a : a + S.WINDOW]).values()
        best = max(best, sum(-c / S.WINDOW * math.log2(c / S.WINDOW) for c in n))
    return best


def spans(text):
    base = [(m.start(), 0, m.end()) for m in re.finditer(S.ASSIGN.replace(r"\x20", " "), text) if len(m[2]) >= S.MIN_VALUE]
    base += [(m.start(), 1, m.end()) for m in re.finditer(S.ACCESS, text)] + [(m.start(), 2, m.end()) for m in re.finditer(S.HEX, text)]
    own = []
    for m in re.finditer(S.CANDIDATE, text):
        need = next(bits for _, pattern, bits in S.CLASSES if re.search(pattern, m[0]))
        if re.search(S.ALLOWED, m[0]) or entropy(m[0]) < need - 1e-12 or re.search(S.ALLOWED_BEFORE, text[: m.start()]):
            continue
        if not any(a <= m.start() and z >= m.end() for a, _, z in base):
            own.append((m.start(), 3, m.end()))
    return sorted(base + own)


def test_all_spans_by_brute_force(spark, rng):
    alphabets = ["0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcXYZdefUVWghiRST", "abc_def/ghi-jkl=MNO+pqr", "a1b2c3d4e5f6-_=", "aB3dE5gH7jK9mN1pQ_r/s+t"]
    before = ["", " ", "https://x.example/a/b?sig=", "sha-256:", "md5 ", "commit ", "é", "token = ", "see http://h/", 'integrity="', "path/", "="]
    texts = []
    for _ in range(120):
        parts = [words(rng, rng.randrange(5))]
        for _ in range(rng.randrange(5)):
            a = rng.choice(alphabets)
            parts.append(rng.choice(before) + "".join(rng.choice(a) for _ in range(rng.choice([10, 20, 25, 40, 80]))) + rng.choice(["", " ", '"', "&x=1"]))
        texts.append(rng.choice([" ", "\n"]).join(parts))
    texts += ["", "password: hunter2", "AKIA" + "A1B2C3D4E5F6G7H8", "0" * 64, "ab" * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [(d["start"], d["kind"], d["end"]) for d in r["found"]] for r in S.scan_secrets(df).collect()}
    assert found == {k: spans(t) for k, t in enumerate(texts)}
    assert {k for f in found.values() for _, k, _ in f} == {0, 1, 2, 3}


@pytest.mark.parametrize("key", ["aB3dE5gH7jK9mN1pQrS2tUv4w", "qzjxkvbwpfyhgmdlcuoraeisnt", "k9x2m7q4z8w1v5j3t6y0r2p8b4"])
def test_the_verdict_does_not_depend_on_what_stands_before(spark, key):
    fronts = ["", "x ", "https://h/?sig=", "https://host.example/" + "a/" * 60 + "?sig=", "https://" + "p" * 500 + "/?sig=", "see: " * 30]
    df = spark.createDataFrame([(k, f"{f}{key} tail") for k, f in enumerate(fronts)], "doc_id long, text string")
    for r in S.scan_secrets(df).collect():
        at = len(fronts[r["doc_id"]])
        assert any(d["kind"] == 3 and d["end"] == at + len(key) for d in r["found"])


def test_every_class_can_be_reached(spark, rng):
    low, up, num = string.ascii_lowercase, string.ascii_uppercase, string.digits
    samples = {"digits": num, "hex": "0123456789abcdef", "alpha_one_case": low, "alpha": low + up, "words": low + up + "_/+", "alnum_one_case": low + num, "base64": low + up + num + "+/"}
    assert all(bits < math.log2(S.WINDOW) for _, _, bits in S.CLASSES) and list(samples) == [c[0] for c in S.CLASSES]
    rows = [(n, "".join(rng.choice(a) for _ in range(60))) for n, a in samples.items() for _ in range(20)]
    got = {r["n"]: r["share"] for r in spark.createDataFrame(rows, "n string, s string").groupBy("n").agg(F.avg(S.is_random(F.col("s")).cast("int")).alias("share")).collect()}
    assert all(got[n] >= 0.8 for n in samples), got


def test_prefix_sums(spark):
    for n in (0, 1, 2, 9, 10, 50):
        values = [k % 7 for k in range(n)]
        got = spark.createDataFrame([(values,)], "v array<int>").select(S.prefix_sums(F.col("v"))).first()[0]
        assert list(got) == [sum(values[:k]) for k in range(n)]


def test_many_matches_cost_about_as_much_each(spark):
    def seconds(n):
        df = spark.createDataFrame([(1, "token: abcdefgh12 x " * n)], "doc_id long, text string")
        began = time.monotonic()
        assert S.scan_secrets(df).first()["n_assign"] == n
        return time.monotonic() - began

    seconds(500)
    assert seconds(16_000) < 12 * max(seconds(2_000), 0.5)
