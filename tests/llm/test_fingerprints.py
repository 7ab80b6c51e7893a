"""op11: fingerprints against a plain version of them, their likeness against the similarity they stand for."""

from __future__ import annotations

import collections
import hashlib
import math
import struct

import pytest
import xxhash

from tests.conftest import SMALL
from wickwork.llm import fingerprints as fp
from wickwork.llm.base import table

QUANTILES = fp.gamma_quantiles()


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def words(text: str) -> collections.Counter:
    return collections.Counter(w.decode() for w in text.encode().split())


def plain(text: str) -> str:
    terms = {signed(xxhash.xxh64_intdigest(w.encode(), seed=42)): n for w, n in words(text).items()} or {42: 1}
    out = []
    for k in range(fp.SAMPLES):
        marks = []
        for term, n in terms.items():
            z = xxhash.xxh64_intdigest(struct.pack("<i", k), seed=xxhash.xxh64_intdigest(struct.pack("<q", term), seed=42))
            r, c, b = QUANTILES[z % fp.LEVELS], QUANTILES[(z >> 12) % fp.LEVELS], ((z >> 24) % 2**20 + 0.5) / 2**20
            t = math.floor(math.log(n) / r + b)
            mark = math.floor((math.log(c) - r * (t - b + 1.0) + 64.0) * 2.0**fp.FRACTION)
            marks.append((mark, ((z >> 44) % 2**16 + t * 40503) % 2**16))
        out.append(f"{min(marks)[1]:04X}")
    return "".join(out)


def likeness(a: str, b: str) -> float:
    return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4)) / fp.SAMPLES


def expected(rows: list[tuple]) -> list[tuple]:
    """Per row (id, text): the contract's columns, in plain Python."""
    key = lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64_intdigest((r[1] or "").encode(), seed=42)))
    rows = sorted(rows, key=key)
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        m = len(text) // 4
        edited = text[: len(text) - m] + after[:m]
        f, e = plain(text), plain(edited)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), f, e, likeness(f, e), likeness(f, plain(after))))
    return sorted(out, key=repr)


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()), key=repr)


ODD = [
    (None, "no id"), (None, None), (1, ""), (2, "   \n"), (3, "a"), (4, "a b c d e f g h"), (4, "another text of four"), (5, "same same text"), (5, "same same text"), (5, "same same text"), (6, "é" * 9 + " ü ß \U0001f600"),
    (7, "w " * 70_000 + "end"), (900, "far away"), (2**61, "further"), (-5, "before all"), (4, "a b c d e f g h"),
]


@pytest.mark.parametrize("most", [fp.MOST, 2, 0])
def test_rows_equal_a_plain_version(spark, most):
    df = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    assert got(fp.fingerprints(df, most=most)) == expected(ODD)


@pytest.mark.parametrize("rows", [[], [(7, "alone in its table")], [(7, None)]])
def test_few_rows(spark, rows):
    assert got(fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_query_on_its_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    short = [(i, t) for i, t in docs if len(t) < 4000]
    assert got(fp.fingerprints(spark.createDataFrame(short, "doc_id long, text string"))) == expected(short)
    assert {(r.doc_id, r.n_chars) for r in fp.query(spark, SMALL).collect()} == {(i, len(t)) for i, t in docs}


def test_order_of_rows_and_other_columns_do_not_matter(spark):
    rows = [(i, f"text {i % 7} with words {'x ' * (i % 11)}", "a", i) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string, pos int")
    assert got(fp.fingerprints(df.repartition(7))) == got(fp.fingerprints(df.orderBy("text").coalesce(1))) == got(fp.fingerprints(df, most=1))


def test_likeness_is_generalised_jaccard(spark):
    """Mean error near 0, and each within five standard errors."""
    texts = [t.text for t in table(spark, SMALL, "documents").select("text").orderBy("doc_id").collect()]
    off = []
    for r, i in zip(sorted(fp.query(spark, SMALL).collect(), key=lambda r: r.doc_id), range(len(texts)), strict=True):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        m = len(text) // 4
        a, b = words(text), words(text[: len(text) - m] + after[:m])
        j = sum((a & b).values()) / max(1, sum((a | b).values())) if a or b else 1.0
        off.append(r.near_edited - j)
        assert abs(off[-1]) <= 5 * math.sqrt(max(j * (1 - j), 0.01) / fp.SAMPLES)
    assert abs(sum(off) / len(off)) < 0.015


def test_one_shuffle_of_texts_and_no_python(spark):
    plan = fp.fingerprints(table(spark, SMALL, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
