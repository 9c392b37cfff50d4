from __future__ import annotations

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from wanderlake.llm import pii
from wanderlake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def field():
    return pii.train(pii.labelled_examples())


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def brute(text: str) -> list[tuple[str, int, int]]:
    """The agreed patterns as written, with their checks."""
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    return [(k, *m.span()) for k, (pattern, good) in rules.items() for m in re.finditer(pattern, text) if good(m[0])]


TEXTS = [
    "", "a@b", "a@b.c", "@a.b", "x a@b.c.d, e@f.g", "a@b.c@d.e", "a@@b.c", "a@b..c", "%a+b@c-.d-", "..@-.-", "a@b.c.@d.e.f",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "1.2.3.0000255", "01.2.3.4x", "1.2.3", "9" * 3000 + ".1.2.3", "1.2.3.4.5",
    "4111111111111111", "4111 1111 1111 1111", "4111-1111 1111-1111", "4111  1111 1111 1111", "41111111111111112", "0" * 12, "0" * 20, "1 2 3",
    "+1 (171) 555-2028", "+1", "+12", "+1 2", "++49 30 1234567..", "+1 (171) 555-2028 +1 (171) 555-2029", "+1.........", "+123456789012345678",
    "é漢😀 a@b.cd 😀 4111111111111111", "q" * 20_000 + "@x.yz", "1" * 20_000, "1-" * 8_000, "a@" * 5_000, "+1 " * 4_000,
]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_patterns_against_brute_force(text):
    assert sorted(pii.base_spans(text)) == sorted(brute(text))


def test_patterns_on_mixed_signs():
    rng = np.random.default_rng(5)
    for signs in ("a@.-1 ", "0123456789.-+ ()", "12. ", "4 -1", "@.a%", "+1 -()."):
        for _ in range(300):
            text = "".join(rng.choice(list(signs), rng.integers(1, 60)))
            assert sorted(pii.base_spans(text)) == sorted(brute(text)), text


def test_viterbi_is_the_best_of_all_tag_rows(field):
    rng = np.random.default_rng(3)
    several = [rng.integers(0, len(field.shapes) + 1, n) for n in (1, 4, 2, 4, 3)]
    noisy = pii.Field(field.shapes, field.around + rng.normal(0, 2, field.around.shape), field.pair_of, field.pairs, field.follow)
    for chain, tags in zip(several, noisy.decode(several), strict=True):
        scores = noisy.scores([chain])

        def total(row, scores=scores):
            return sum(scores[i, y] + noisy.follow[(row[i - 1] if i else 0), y] for i, y in enumerate(row))

        best = max(itertools.product(range(len(pii.TAGS)), repeat=len(chain)), key=total)
        assert total(tuple(tags)) == pytest.approx(total(best))


def test_gradient_is_that_of_the_likelihood(field):
    rng = np.random.default_rng(4)
    several = [rng.integers(0, len(field.shapes) + 1, n) for n in (5, 3, 1)]
    lengths, truth = np.array([5, 3, 1]), np.array([0, 1, 2, 2, 0, 3, 4, 0, 5])
    shapes, pairs = field.features(several)
    _, by_token, by_follow = pii.gradient(field, shapes, pairs, lengths, truth)

    def loss():
        return pii.gradient(field, shapes, pairs, lengths, truth)[0]

    for place in ((0, 0), (1, 2), (0, 3)):
        kept = field.follow[place]
        field.follow[place] = kept + 1e-4
        up = loss()
        field.follow[place] = kept - 1e-4
        down = loss()
        field.follow[place] = kept
        assert (up - down) / 2e-4 == pytest.approx(by_follow[place], abs=1e-4)
    k, tag = int(shapes[2, 2]), 3
    kept = field.around[2, k, tag]
    field.around[2, k, tag] = kept + 1e-4
    up = loss()
    field.around[2, k, tag] = kept - 1e-4
    down = loss()
    field.around[2, k, tag] = kept
    assert (up - down) / 2e-4 == pytest.approx(by_token[shapes[:, 2] == k, tag].sum(), abs=1e-4)


def test_held_out_spellings(field):
    rows = pii.labelled_examples(400, seed=99)
    found = pii.Finder(field).find([t for t, _ in rows])
    right = wrong = missed = 0
    for (text, spans), got in zip(rows, found, strict=True):
        got = {(k, s, e) for k, s, e, _ in got} - set(brute(text))
        want = set(spans) - set(brute(text))
        right, wrong, missed = right + len(got & want), wrong + len(got - want), missed + len(want - got)
    assert right > 60 and right / (right + wrong) > 0.85 and right / (right + missed) > 0.85


def test_plain_text_has_no_spans(field):
    clean = [prose(i, 400) + f" In {1900 + i} it cost {i}.50 at 12:{10 + i}, see 3.{i}." for i in range(40)]
    assert pii.Finder(field).find(clean) == [[] for _ in clean]


def test_blocks_of_a_long_chain_agree_with_one(field, monkeypatch):
    text = "call (171) 555-2028, 10[.]0[.]0[.]1 or " * 60
    whole = pii.Finder(field).find([text])[0]
    monkeypatch.setattr(pii, "BLOCK", 64)
    monkeypatch.setattr(pii, "CONTEXT", 24)
    assert pii.Finder(field).find([text])[0] == whole and len(whole) == 120


def test_edges_and_redaction(spark, field):
    texts = [None, "", "  ", "mail a@b.cd or 4111 1111 1111 1111.", "mail a@b.cd or 4111 1111 1111 1111.", "call (171) 555-2028 now", "é😀 +1 (171) 555-2028", "x" * 300_000 + " 10.0.0.1"]
    df = spark.createDataFrame([(i % 7 or None, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, pii_spans string, start string")
    rows = pii.find_personal_data(df, field).withColumn("whole", F.col("text")).collect()
    assert len(rows) == len(texts)
    by_text = {r["whole"]: [(s["kind"], s["start"], s["end"], s["base"]) for s in r["pii_spans"]] for r in rows}
    assert by_text[None] == by_text[""] == by_text["  "] == []
    assert by_text[texts[3]] == [("email", 5, 11, True), ("card", 15, 34, True)]
    assert by_text[texts[5]] == [("phone", 5, 19, False)] and by_text[texts[6]] == [("phone", 3, 20, True)]
    assert by_text[texts[7]] == [("ip", 300_001, 300_009, True)]
    out = [r["text"] for r in pii.redacted(pii.find_personal_data(df, field)).collect()]
    assert out[:6] == [None, "", "  ", "mail [email] or [card].", "mail [email] or [card].", "call [phone] now"]
    assert out[7] == "x" * 300_000 + " [ip]"
    assert pii.find_personal_data(df.limit(0), field).count() == 0


def test_query_against_brute_force(spark):
    import hashlib

    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op13_pii"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = sorted(brute(texts[r["doc_id"]]), key=lambda s: (s[1], pii.KINDS.index(s[0])))
        named = [f"{k}:{s}:{e}" for k, s, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(named) <= set(r["spans"].split(","))
