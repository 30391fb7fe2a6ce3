"""Conversation repair against all edit sequences, against a chart over every
split of every span, and against plain Python for damage and digests."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from barpanel.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


# -- brute force ------------------------------------------------------------------

def all_sequences(rows):
    """Least (cost, audit) over every edit sequence; rows: (initial, gone, cut)."""
    gaps = [x for k in range(3) for x in itertools.product("ua", repeat=k)]
    per = []
    for initial, gone, cut in rows:
        c = [("D", "", 4)]
        if not gone:
            c += [("K", initial, 3 * cut), ("R", "u", 3 + 3 * cut), ("R", "a", 3 + 3 * cut)]
        per.append(c)
    best = None
    for edits in itertools.product(*per):
        for ins in itertools.product(gaps, repeat=len(rows) + 1):
            out, audit, cost = "", "", 0
            for i, g in enumerate(ins):
                out += "".join(g)
                audit += "I" * len(g)
                cost += 3 * len(g)
                if i < len(edits):
                    e = edits[i]
                    out, audit, cost = out + e[1], audit + e[0], cost + e[2]
            if PATTERN.fullmatch(out) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def full_chart(rows):
    """CYK over all spans by length and all splits, (cost, audit) cells."""
    chart, n = {}, len(rows)
    for i, r in enumerate(rows):
        chart[i, i + 1] = R.row_cells(*r)
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell = {}
            for k in range(i + 1, i + length):
                for key, (c, a) in R.combine(chart[i, k], chart[k, i + length]).items():
                    if key not in cell or (c, a) < cell[key]:
                        cell[key] = (c, a)
            chart[i, i + length] = cell
    return R.best(chart[0, n]) if n else (0, "")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def replayed(rows, audit):
    m = len(audit) - audit.count("D")
    initials = ("s" if m % 2 else "") + "ua" * (m // 2)
    out, todo = [], list(rows)
    for e in audit:
        role, text = (None, "") if e == "I" else todo.pop(0)
        if e != "D":
            i = initials[len(out)]
            out.append(f"{role if e == 'K' else {'u': 'user', 'a': 'assistant'}[i]}:{text}")
    assert not todo
    return out


def brute(original, rows):
    out = {}
    for conv in {r[0] for r in original}:
        own = sorted(((r[1] is not None, r[1] or 0, r[2], r[3]) for r in rows if r[0] == conv),
                     key=lambda r: (*r[:2], r[2].encode(), r[3].encode()))
        seen, classes, n = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, _, role, text in own:
            t = text.rstrip(" \t\n\x0b\x0c\r")
            blank, again, cut = not t, (role, text) in seen, t[-1:] not in tuple(".!?")
            seen.add((role, text))
            n["blank"] += blank
            n["duplicate"] += not blank and again
            n["truncated"] += not blank and not again and cut
            classes.append((role[:1], blank or again, bool(cut and not blank and not again)))
        turns = [r[1] for r in own if r[0]]
        cost, audit = full_chart(classes) if classes else (0, "")
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        text = "\n".join(replayed([r[2:] for r in own], audit))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"],
                     n["duplicate"], n["truncated"], illegal, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


COLS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def got(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLS) for r in rows}
    assert len(out) == len(rows)
    return out


# -- grammar ------------------------------------------------------------------------

def classes(rng, n):
    out = []
    for _ in range(n):
        gone = rng.random() < 0.25
        out.append((rng.choice("suax"), gone, not gone and rng.random() < 0.3))
    return out


def chart_of(rows):
    c = R.Chart()
    for r in rows:
        c.add(R.row_cells(*r))
    return R.best(c.cells())


def test_small_conversations_against_every_edit_sequence():
    for initials in itertools.product("sua", repeat=2):
        rows = [(x, False, False) for x in initials]
        assert chart_of(rows) == all_sequences(rows)
    rng = random.Random(1)
    for n in (0, 1, 1, 1, 2, 2, 2, 2, 3, 3, 3):
        rows = classes(rng, n)
        assert chart_of(rows) == all_sequences(rows) == full_chart(rows) if rows else (0, "")


def test_one_split_of_a_span_is_as_good_as_all():
    rng = random.Random(2)
    for n in list(range(1, 12)) * 4 + [30, 40]:
        rows = classes(rng, n)
        assert chart_of(rows) == full_chart(rows)


def test_run_of_deleted_rows():
    for n in (1, 2, 5):
        c = R.Chart()
        for _ in range(n):
            c.add(R.row_cells("u", True, False))
        assert c.cells() == R.deleted_cells(n)


# -- on Spark ------------------------------------------------------------------------

def conversations(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", "  ", "Well! ", "a. b", None, "é.\n", "x\x0b"]
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 9])):
            role = rng.choice(["user", "assistant"]) if turn else rng.choice(["system", "user"])
            if rng.random() < 0.1:
                role = rng.choice([None, "", "tool", "usher"])
            rows.append((conv, rng.choice([turn, turn, turn, None, 3 * turn]), role,
                         rng.choice(texts)))
    rows += rows[:7] + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hi."), (-5, None, None, None)]
    return rows


def frame(spark, rows, clash=False):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in
                            ("has_id", "conv", "at", "part", "copies", "kind")]) if clash else df


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_brute_force(spark, tmp_path, seed):
    from barpanel.llm.queries import QUERIES
    rows = conversations(seed, 120)
    frame(spark, rows, clash=seed == 2).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(QUERIES["op13_conversation_repair"](spark, str(tmp_path))) == brute(
        rows, damaged(rows))


def test_given_table(spark):
    from barpanel.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_conversation_repair"](spark, sf)) == brute(rows, damaged(rows))


def test_hot_conversation_spans_partitions(spark):
    """One conversation holds most rows, cut into segments by the shuffle."""
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"t{t % 50}" + rng.choice([".", ""]))
            for t in range(120)] + conversations(5, 10)
    df = frame(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(R.repair(df, df)) == brute(rows, [(a, b, " " if c is None else c,
                                                      " " if d is None else d)
                                                     for a, b, c, d in rows])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_many_equal_rows_and_long_texts(spark):
    rows = ([(1, 0, "user", "Same.")] * 3000 + [(1, 1, "assistant", "word " * 50_000 + ".")]
            + [(2, 0, "user", " " * 50_000), (3, 5, "user", "a" * 50_000)])
    want = brute(rows[-3:] + rows[:3], rows[-3:] + rows[:3])
    r = got(R.repair(frame(spark, rows), frame(spark, rows)))
    assert r[2] == want[2] and r[3] == want[3]
    assert r[1] == (0, 0, 2999, 0, 2999, 4 * 2999, "K" + "D" * 2999 + "K",
                    hashlib.sha256(("user:Same.\nassistant:" + "word " * 50_000 + ".").encode())
                    .hexdigest())


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "A?"), (1, 1, "user", "B?"), (1, 2, "assistant", "C."),
            (2, 0, "system", "S."), (2, 1, "assistant", "D."), (3, 0, "user", "")]
    got_ = {}
    for r in sorted(R.repaired(frame(spark, rows)).collect(), key=lambda r: (r[0], r[1])):
        got_.setdefault(r["conv_id"], []).append((r["position"], r["role"], r["text"], r["edit"]))
    assert got_ == {
        1: [(0, "user", "A?", "K"), (1, "assistant", "", "I"), (2, "user", "B?", "K"),
            (3, "assistant", "C.", "K")],
        2: [(0, "system", "S.", "K"), (1, "user", "", "I"), (2, "assistant", "D.", "K")]}


def test_empty_table(spark):
    df = frame(spark, [])
    assert got(R.repair(R.damage(df), df)) == {}
    assert R.repaired(df).count() == 0
