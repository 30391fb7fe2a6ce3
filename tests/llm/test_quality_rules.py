import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from barpanel.llm import quality_rules as q
from tests.llm.helpers import docs, prose


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = list(zip(w, w[1:], w[2:]))
    c = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if c[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
            len(re.findall("[A-Z]", t)), len(re.findall("[A-Za-z]", t)),
            len(re.findall("[A-Za-z\x80-\U0010ffff]", t)))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\x85 é#B|😀", max_size=50))
def test_measures(t):
    assert q.measure_text(t) == brute(t)


def table():
    rng = random.Random(1)
    good = prose(rng, 120)
    return [good, None, "", "short text", " ".join(["a b c d"] * 60), good.upper(),
            " ".join(x + "***" for x in good.split()), "x" * 200_000, "日本 " * 100,
            "\n".join([good[:100]] * 10 + [good]), "1 2 3 " + " ".join(map(str, range(100))), good]


def test_ledger_and_policy(spark):
    texts = table()
    led = q.ledger(docs(spark, texts, clash=True))
    got = {r.doc_id: r for r in q.apply_policy(led).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        m = brute(t)
        r = got[i]
        assert tuple(r[1:10]) == m
        base = m[0] < 50 or 100 * m[5] > 50 * m[0]
        assert r.base_failed == base and not (base and r.kept)
    assert [got[i].kept for i in (0, 11, 8)] == [True, True, False]
    assert not any(got[i].kept for i in (1, 2, 3, 4, 5, 6, 7, 10))
    first = {r.doc_id for r in q.apply_policy(led, 1).filter("kept").collect()}
    assert {0, 5, 6, 11} <= first


def test_ablation(spark):
    led = q.ledger(docs(spark, table()))
    failed = [r.failed for r in led.collect()]
    got = {r.rule: r for r in q.ablation(led).collect()}
    assert set(got) == set(q.RULES)
    for i, rule in enumerate(q.RULES):
        bit = 1 << i
        assert tuple(got[rule])[1:] == (
            sum(f & bit != 0 for f in failed), failed.count(bit), failed.count(0),
            sum(f & ~bit == 0 for f in failed))


def test_keep_rows_and_odd_rows(spark):
    texts = table()
    df = docs(spark, texts, [None, *range(1, len(texts))], clash=True)
    got = q.keep_rows(df)
    assert got.columns == df.columns
    kept = {r.doc_id for r in q.apply_policy(q.ledger(df)).filter("kept").collect()}
    assert {r.doc_id for r in got.collect()} == kept and None in kept
    assert q.ledger(docs(spark, [])).count() == 0
