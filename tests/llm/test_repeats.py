"""Repeated rows, tied ids and very long values: op4, op5, op6, op10."""

from __future__ import annotations

import random
import string
import time

import pytest
from pyspark.sql import functions as F

from wickwork.llm import line_dedup, mixing, pii, quality_rules

KEY = pii.Feistel(b"k")
KINDS = {"hex": "0123456789abcdef", "word": string.ascii_letters + string.digits + "!@#", "ticket": string.ascii_letters + string.digits + "-"}


def secret(rng: random.Random, kind: str, n: int) -> str:
    s = "".join(rng.choice(KINDS[kind]) for _ in range(n))
    return s if kind == "hex" else "a1" + s[2:]


def hidden(text: str) -> str:
    return pii.rewrite(KEY, text)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("n", [10, 97, 128, 129, 151, 700, 3_000])
def test_no_part_of_a_value_stays(kind, n):
    """Places keep their character about as often as chance has it, also where one character of the value differs."""
    rng = random.Random(n)
    before = "Bearer " if kind == "ticket" else "token="
    same = kept = total = 0
    rounds = max(4, 2_000 // n)
    by_place = [0] * n
    for _ in range(rounds):
        s = secret(rng, kind, n)
        at = rng.randrange(2, n)
        other = s[:at] + rng.choice([c for c in KINDS[kind] if c != s[at] and (kind == "hex" or c.isalnum() and (c.isdigit(), c.isupper(), c.islower()) == (s[at].isdigit(), s[at].isupper(), s[at].islower()))] or [s[at]]) + s[at + 1 :]
        a, b = hidden(before + s)[len(before) :], hidden(before + other)[len(before) :]
        assert len(a) == n and pii.rewrite(KEY, before + a, None, True) == before + s
        for i in range(n):
            if kind != "hex" and not s[i].isalnum():
                continue
            total += 1
            kept += a[i] == s[i]
            by_place[i] += a[i] == s[i]
            same += a[i] == b[i] if other != s else 0
    chance = 1 / 16 if kind == "hex" else 1 / 10
    assert kept <= chance * total + 6 * (chance * total) ** 0.5 and same <= chance * total + 6 * (chance * total) ** 0.5
    assert max(by_place) < rounds


@pytest.mark.parametrize("text", ["a" * 4_000 + "1@" + "b" * 3_000 + ".org", "token=" + "0123456789abcdef" * 300, "password: a1" + "Zz9" * 2_000, "sk-" + "Ab3" * 1_000, "x=1 token=" + "f" * 100_000, '{"password": "' + "q7" * 50_000 + '"}'])
def test_long_values_turn_back(text):
    began = time.time()
    out = hidden(text)
    assert out != text and len(out) == len(text) and pii.rewrite(KEY, out, None, True) == text
    assert time.time() - began < 5


def test_time_is_linear():
    for text in ("%" * 100_000, "%a" * 50_000, "token=" * 20_000, "1-" * 50_000, "a.b" * 40_000, '"password"' * 10_000, "bearer " * 10_000):
        began = time.time()
        pii.rewrite(KEY, text)
        assert time.time() - began < 1, text[:10]


@pytest.mark.parametrize("before", ['{"password": "', "{'secret': '", "api-key: ", "API_KEY=", "Authorization: Bearer ", "bearer  ", "ghp_", "sk-"])
def test_secrets_in_their_usual_forms(before):
    rng = random.Random(1)
    for n in (16, 36, 90):
        s = "a1" + "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
        after = {'{"': '"}', "{'": "'}"}.get(before[:2], " and more")
        text = f"see {before}{s}{after}"
        counts: dict = {}
        out = pii.rewrite(KEY, text, counts)
        assert counts == {"secret": 1} and s not in out and out.startswith(f"see {before}") and out.endswith(after)
        assert pii.rewrite(KEY, out, None, True) == text


def test_a_plain_network_gives_the_same_numbers():
    """The permutation, written again from its description."""
    import hashlib

    def permuted(tag: str, n: int, x: int) -> int:
        a = 1
        while a * a < n:
            a += 1
        b = (n + a - 1) // a
        while True:
            left, right = x // b, x % b
            for i in range(8):
                half, size = (left, b) if i % 2 else (right, a)
                r = int.from_bytes(hashlib.blake2b(f"{tag}|{n}|{i}|{half}".encode(), key=b"k", digest_size=24).digest(), "big") % size
                if i % 2:
                    right = (right + r) % b
                else:
                    left = (left + r) % a
            x = left * b + right
            if x < n:
                return x

    for n in (2, 10, 26, 1000, 73_049):
        assert sorted(permuted("t", n, x) for x in range(min(n, 1000))) == sorted(KEY.permute("t", n, x) for x in range(min(n, 1000)))
        assert all(permuted("t", n, x) == KEY.permute("t", n, x) for x in range(min(n, 200)))


def test_line_dedup_is_linear_in_repeated_rows(spark):
    """300 shared lines in six documents; one of them repeated: time grows as the rows do, the result is that of one."""
    text = "\n".join(f"a line that many documents share, number {i:04d}" for i in range(300))
    took = {}
    for n in (500, 500, 4_000):
        rows = [(1, text)] * n + [(i, text) for i in range(2, 7)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        began = time.time()
        out = line_dedup.dedup_lines(df).groupBy("doc_id", "n_lines", "n_dropped").count().collect()
        took[n] = time.time() - began
        assert sorted((r.doc_id, r.n_lines, r.n_dropped, r["count"]) for r in out) == [(1, 300, 300, n), *((i, 300, 300, 1) for i in range(2, 6)), (6, 300, 0, 1)]
    assert took[4_000] < 12 * max(took[500], 1)


def test_one_good_text_certifies_nothing_however_often(spark):
    good = " ".join(f"word{i}" for i in range(30))
    docs = [(1, good, "en")] * 3_000 + [(10 + i, good, "en") for i in range(3_000)] + [(9_000 + i, " ".join(f"#{k}#{i}#" for k in range(30)), "en") for i in range(50)]
    labels = [(1, 1)] + [(10 + i, 1) for i in range(3_000)] + [(9_000 + i, 0) for i in range(50)]
    counted = quality_rules.counts(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    found = spark.createDataFrame(labels, "doc_id long, quality int")
    assert quality_rules.certified(counted, found).collect() == []
    different = [(i, f"{good} {i}", "en") for i in range(3_000)] + docs[6_000:]
    counted = quality_rules.counts(spark.createDataFrame(different, "doc_id long, text string, lang string"))
    more = spark.createDataFrame([(i, 1) for i in range(3_000)] + labels[-50:], "doc_id long, quality int")
    assert all(r.good == 3_000 for r in quality_rules.certified(counted, more).collect()) and quality_rules.certified(counted, more).count()


def test_mix_of_tied_ids_meets_its_target(spark, duck):
    """Sources whose rows share an id, or an id and a text: within one document of the target, at any number of tasks."""
    rows = [(None, f"w{i} x y", "a") for i in range(900)] + [(7, f"w{i} x y", "b") for i in range(900)] + [(None, "x y z", "c")] * 900 + [(7, "q " * 3, "e")] * 400 + [(1_000 + i, "b c " * (1 + i % 3), "d") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = None
    for tasks in (1, 16):
        out = mixing.mix(df.repartition(tasks)).cache()
        sums = {r.source: (r.taken, r.target) for r in out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
        assert all(abs(taken - target) <= 6 for taken, target in sums.values()), sums
        assert out.where("taken > 3 * size").count() == 0
        got = sorted(map(repr, out.select("doc_id", "size", "source_size", "target", "taken").collect()))
        assert want is None or got == want
        want = got
    assert mixing.mixed(df.repartition(3)).groupBy("source").count().orderBy("source").collect() == out.groupBy("source").agg(F.sum("copies").cast("long").alias("count")).orderBy("source").collect()
    duck.register("tied", df.toPandas().astype({"doc_id": "Int64"}))
    sql = duck.execute("with " + mixing.SQL.strip().removeprefix("with ").replace("from documents", "from tied")).fetchall()
    assert sorted(x[4] for x in sql) == sorted(r.taken for r in out.collect())
