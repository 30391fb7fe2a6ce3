"""Quality rules as a bitmask ledger (operator 10).

``ledger`` evaluates every rule once per document and stores the failure bits
next to the measurements. Policies are versioned sets of bits applied to the
stored ledger, so a change of policy re-reads a narrow table, never the texts.
``ablation`` answers "what would be kept without rule r" for all rules from
counts per distinct bitmask.

Defined cases: a null or empty text has no word (all counts 0, mean 0.0) and
fails ``few_words`` only; a null ``doc_id`` is carried through; repeated rows
are judged one by one; texts of any length are read whole; a limit that is met
exactly (a tie) passes; an empty table gives an empty ledger; columns of the
input other than the id and the text are neither read nor returned.

Letters are A-Z, a-z (``n_latin``) and every code point beyond ASCII
(``n_letters`` counts both), so scripts without case never fail for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barpanel.llm.common import SPACES, appended, pieces, restored, schema_of, texts

SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words long,word_chars long,n_symbols long,n_lines long,n_dup_lines long,"
            "n_repeat_words long,n_upper long,n_latin long,n_letters long")

#: name -> failure condition over the measurements, by bit position. Appending
#: keeps stored ledgers valid; bits are never reused.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words AND n_words > 0",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)",
    "duplicate_lines": "n_lines > 3 AND 100 * n_dup_lines > 70 * n_lines",
    "upper_case": "2 * n_latin > word_chars AND 100 * n_upper > 80 * n_latin",
    "few_letters": "n_words > 0 AND 100 * n_letters < 30 * word_chars",
}

#: The rules that any policy includes.
BASE = ("few_words", "repeated_words")

#: version -> rules whose failure rejects a document.
POLICIES: dict[int, tuple[str, ...]] = {
    1: BASE,
    2: tuple(RULES),
}
CURRENT = 2


def bits(names) -> int:
    order = list(RULES)
    return sum(1 << order.index(n) for n in names)


def repeated_word_count(words: list) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict = {}
    w = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, n)
    v = len(number)
    pair = np.unique(w[:-1] * v + w[1:], return_inverse=True)[1]
    _, inv, cnt = np.unique(pair[:-1] * v + w[2:], return_inverse=True, return_counts=True)
    hit = np.flatnonzero(cnt[inv] > 1)
    covered = np.zeros(n + 3, np.int8)
    for k in range(3):
        covered[hit + k] = 1
    return int(covered.sum())


def measure_text(t: str) -> tuple[int, ...]:
    data = t.encode()
    words = data.split()  # on the six ASCII white-space characters
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper = int(of[65:91].sum())
    latin = upper + int(of[97:123].sum())
    other = int(of[192:].sum())  # first bytes of code points beyond ASCII
    n_space = sum(int(of[ord(c)]) for c in SPACES)
    return (len(words), len(t) - n_space, sum(int(of[ord(c)]) for c in SYMBOLS), len(lines),
            len(lines) - len(set(lines)), repeated_word_count(words), upper, latin, latin + other)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of measurements per document."""
    out = schema_of(f"doc_id long,{MEASURES}")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            got = list(zip(*map(measure_text, texts(b))))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in got)], schema=out)

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, "doc_id long," + MEASURES)


def failure_bits() -> Column:
    """The bitmask of failed rules, in one expression over the measurements."""
    out = F.lit(0).cast("long")
    for i, cond in enumerate(RULES.values()):
        out = out.bitwiseOR(F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return out


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and ``failed`` (bitmask, long) per document."""
    return measure(docs, id_col, text_col).withColumn("failed", failure_bits())


def apply_policy(led: DataFrame, version: int = CURRENT) -> DataFrame:
    """Adds ``base_failed``, ``policy`` and ``kept`` to a ledger."""
    base, mask = bits(BASE), bits(POLICIES[version])
    return led.withColumns({
        "base_failed": F.col("failed").bitwiseAND(F.lit(base)) != 0,
        "policy": F.lit(version),
        "kept": F.col("failed").bitwiseAND(F.lit(base | mask)) == 0})


def keep_rows(docs: DataFrame, version: int = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that a policy keeps."""
    led = appended(docs, MEASURES, lambda ts: zip(*map(measure_text, ts)), text_col)
    return restored(apply_policy(led.withColumn("failed", failure_bits()), version)
                    .filter("kept"), docs)


def ablation(led: DataFrame, version: int = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, fail only it, and the
    documents kept with the policy and without the rule. The texts are not
    read; documents are pre-aggregated to one count per distinct bitmask."""
    rules = F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
        for i, n in enumerate(RULES) if n in POLICIES[version]])).alias("r")
    mask = bits(POLICIES[version])
    counts = (led.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("failed"))
              .agg(F.count(F.lit(1)).alias("n")))
    hit = F.col("failed").bitwiseAND(F.col("r.bit")) != 0

    def total(cond):
        return F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0)))
    return (counts.select("failed", "n", rules)
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(total(hit).alias("n_failed"),
                 total(F.col("failed") == F.col("r.bit")).alias("n_failed_alone"),
                 total(F.col("failed") == 0).alias("n_kept"),
                 total((F.col("failed") == 0) | (F.col("failed") == F.col("r.bit")))
                 .alias("n_kept_without")))
