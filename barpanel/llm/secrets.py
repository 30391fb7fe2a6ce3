"""Secret scans (operator 6).

Two detectors over whole texts:

* *patterns*: assignments to a secret-like name, access key ids and long hex
  runs (``base_spans``);
* *randomness*: every run of 20 or more characters of an encoding alphabet is a
  candidate. Its encoding is inferred (hex, base32 and base36 in either case,
  base62, base64), and three tests, joined into one p-value, ask whether it
  is random: chi-squared distance from the uniform alphabet, runs above and
  below the alphabet's middle, and lag-one serial correlation. What passes is
  held against ordinary text: letters drawn from the corpus's own frequencies
  in one case, whose chi-squared distance grows with length, so the tests know
  the length. These p-values pass a Benjamini-Hochberg step in every length
  band, from a histogram whose size does not depend on the corpus.

A span is (kind, start, end) in code points, end exclusive. Spans of the
randomness test that touch a pattern span are dropped: patterns stay.

Defined cases: a null or empty text has no span; texts of any length are read
whole; overlapping spans of different kinds are all kept, by start and kind; a null ``doc_id`` is carried
through; repeated rows are scanned one by one; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpanel.llm.common import appended, cut, pieces, restored, schema_of, texts

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
NAMES = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE, MIN_ACCESS = 12, 18

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Expected share of false finds among the randomness test's finds.
FDR = 0.001
#: Strings less likely than this from a random source are not taken for random.
RANDOM_FROM = 0.002
#: Upper ends of the length bands that control false discovery apart.
BANDS = (24, 32, 40, 64, 128, 1 << 30)
_HEXDIGITS = frozenset("0123456789abcdef")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"
#: Alphabets in the order of their codes, narrow ones first; hex has its own rule.
ALPHABETS = {"base32": _UPPER + "234567", "base32 lower": _LOWER + "234567",
             "base36": _DIGITS + _UPPER, "base36 lower": _DIGITS + _LOWER,
             "base62": _UPPER + _LOWER + _DIGITS, "base64": _UPPER + _LOWER + _DIGITS + "+/"}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern detectors, sorted."""
    out = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out.sort()
    return out


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of encoding characters that touch no pattern span and mix at least
    two of lower case, upper case and digits after their first character."""
    out = []
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        if any(a < e and s < b for a, _, b in taken):
            continue
        body = text[s + 1:e]
        mixed = ((not body.islower()) and (not body.isupper()))
        if mixed or any("0" <= c <= "9" for c in body):
            out.append((s, e))
    return out


# -- the test battery -----------------------------------------------------------

def encoding(token: str) -> tuple[str, int]:
    """The narrowest alphabet that holds the token, and its size."""
    chars = set(token.rstrip("="))
    if chars <= _HEXDIGITS or {c.lower() for c in chars} <= _HEXDIGITS and \
            not (chars & set("abcdef") and chars & set("ABCDEF")):
        return "hex", 16
    return next(((k, len(a)) for k, a in ALPHABETS.items() if chars <= _AT[k].keys()),
                ("base64", 64))


_AT = {k: {c: i for i, c in enumerate(a)} for k, a in ALPHABETS.items()}
_AT["base64"] |= {"-": 62, "_": 63}


def codes(token: str, kind: str) -> np.ndarray:
    t = token.rstrip("=")
    if kind == "hex":
        return np.array([int(c, 16) for c in t], np.int64)
    return np.array([_AT[kind][c] for c in t], np.int64)


def _normal_tail(z: float) -> float:
    """P(Z <= z) of the standard normal."""
    return 0.5 * math.erfc(-z / math.sqrt(2))


def chi_squared(counts: np.ndarray, n: int) -> float:
    """Pearson's distance from the uniform alphabet."""
    k = len(counts)
    return float((counts.astype(float) ** 2).sum() * k / n - n)


def chi_moments(p: np.ndarray, n: int) -> tuple[float, float]:
    """Mean and variance of that distance for n letters drawn from ``p``.

    With S = sum of squared counts, E S = n + n(n-1) s2 and, counting equal
    pairs of draws, Var S = 4 Var(pairs), where two pairs that share a draw
    are dependent through s3."""
    k = len(p)
    s2, s3 = float((p ** 2).sum()), float((p ** 3).sum())
    mean = (n + n * (n - 1) * s2) * k / n - n
    pairs = n * (n - 1) / 2
    var_pairs = pairs * s2 * (1 - s2) + n * (n - 1) * (n - 2) * (s3 - s2 * s2)
    return mean, 4 * max(var_pairs, 1e-9) * (k / n) ** 2


def runs_z(code: np.ndarray, size: int) -> float:
    """Wald-Wolfowitz runs of values in the lower and upper half."""
    up = code >= size // 2
    n1, n = int(up.sum()), len(up)
    n2 = n - n1
    if n1 == 0 or n2 == 0:
        return -math.sqrt(n)  # a single run
    r = 1 + int((up[1:] != up[:-1]).sum())
    mean = 1 + 2 * n1 * n2 / n
    var = 2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * (n - 1))
    return (r - mean) / math.sqrt(var) if var > 0 else 0.0


def serial_z(code: np.ndarray) -> float:
    """Lag-one correlation of the values, about N(0, 1) for random ones."""
    x = code - code.mean()
    ss = float((x * x).sum())
    return float((x[1:] * x[:-1]).sum()) / ss * math.sqrt(len(x)) if ss > 0 else math.sqrt(len(x))


def case_classes(token: str) -> int:
    """Changes between lower case, upper case, digits and other signs."""
    cls = np.array([0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3
                    for c in token.rstrip("=")])
    return int((cls[1:] != cls[:-1]).sum())


def p_value(token: str, letters: np.ndarray) -> float:
    """How likely ordinary text of this length looks as random as the token.

    First, whether it is random at all: chi-squared distance, runs and serial
    correlation each give the p-value of a random string of the token's alphabet
    and length, and Fisher's sum joins the three. Tokens below ``RANDOM_FROM`` score 1:
    dates, counters, paths and repeated patterns.

    Then, whether text could be so: text is a run of letters in one case; against
    it the chi-squared distance of random characters is too small (they use the
    whole alphabet evenly), and their class (lower, upper, digit) changes too
    often. Both p-values are joined likewise."""
    kind, size = encoding(token)
    code = codes(token, kind)
    n = len(code)
    if n < 16:
        return 1.0
    counts = np.bincount(code, minlength=size)
    x2 = chi_squared(counts, n)
    if p_random(code, size, x2) < RANDOM_FROM:
        return 1.0
    null = np.zeros(size)
    if kind == "hex":
        null[10:] = letters[:6]
        null = null / null.sum() if null.sum() > 0 else np.full(size, 1 / size)
    else:
        first = _AT[kind].get("a", _AT[kind].get("A"))
        null[first:first + 26] = letters
    mean, var = chi_moments(null, n)
    p_chi = _normal_tail((x2 - mean) / math.sqrt(var))
    # class changes of text: rare (a capital, a joined number), about Poisson
    lam, c = 0.1 * n, case_classes(token)
    p_cls = 1.0 if c <= lam else math.exp(min(0.0, c - lam - c * math.log(c / lam)))
    return fisher(p_chi, p_cls)


def p_random(code: np.ndarray, size: int, x2: float) -> float:
    """How likely a random string of the alphabet is as uneven, or as far from
    its expected runs and from no serial correlation."""
    df = size - 1  # Wilson-Hilferty
    even = ((x2 / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return fisher(_normal_tail(-even), 2 * _normal_tail(-abs(runs_z(code, size))),
                  2 * _normal_tail(-abs(serial_z(code))))


def fisher(*ps: float) -> float:
    """The tail of -2 sum(ln p), chi-squared with twice as many degrees of
    freedom as there are p-values."""
    x = -sum(math.log(max(p, 1e-290)) for p in ps)
    terms, t = 1.0, 1.0
    for i in range(1, len(ps)):
        t *= x / i
        terms += t
    return max(math.exp(-x) * terms, 1e-290)


# -- false-discovery control ------------------------------------------------------

#: Histogram cells of -log10(p): 0.25 wide, the last one open.
CELLS, WIDTH = 200, 0.25


def cell_of(p: float) -> int:
    return min(CELLS - 1, int(-math.log10(p) / WIDTH))


def bh_cells(hist: np.ndarray, fdr: float) -> int:
    """The lowest cell that Benjamini-Hochberg accepts, by the largest p-value
    of each cell; ``CELLS`` when none is."""
    m = hist.sum()
    accepted = hist[::-1].cumsum()[::-1]
    worst = 10.0 ** (-WIDTH * np.arange(CELLS))
    ok = np.flatnonzero((accepted > 0) & (worst * m <= fdr * accepted))
    return int(ok[0]) if ok.size else CELLS


@dataclass(frozen=True)
class Null:
    """What the corpus says of ordinary text: the shares of its letters, and
    the lowest accepted cell of each length band."""
    letters: np.ndarray
    least: tuple[int, ...]


def band_of(n: int) -> int:
    return next(i for i, top in enumerate(BANDS) if n <= top)


def calibrate(docs: DataFrame, fdr: float = FDR, text_col: str = "text") -> Null:
    """Counts the letters of all texts, tests every candidate of the corpus
    against them and runs Benjamini-Hochberg in each length band. 26 letter
    counts and a histogram of fixed size come back, whatever the corpus."""

    def find(batches) -> Iterator[pa.RecordBatch]:
        schema = schema_of("token string,letters array<long>")
        for b in pieces(batches, "text"):
            tokens, counts = [], np.zeros(256, np.int64)
            for t in texts(b):
                tokens += [t[s:e] for s, e in candidates(t, base_spans(t))]
                counts += np.bincount(np.frombuffer(t.encode(), np.uint8), minlength=256)
            letters = (counts[97:123] + counts[65:91]).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *tokens], pa.string()),
                 pa.array([letters] + [None] * len(tokens), schema.field(1).type)], schema=schema)

    found = cut(docs.select(F.col(text_col).alias("text"))
                .mapInArrow(find, "token string,letters array<long>"))
    n = (found.filter("letters IS NOT NULL").select(F.posexplode("letters").alias("i", "n"))
         .groupBy("i").agg(F.sum("n").alias("n")))
    letters = np.ones(26)
    for r in n.collect():  # 26 rows
        letters[r["i"]] += r["n"]
    letters = letters / letters.sum()

    def test(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = b.column("token").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([band_of(len(t)) for t in tokens], pa.int32()),
                 pa.array([cell_of(p_value(t, letters)) for t in tokens], pa.int32())],
                schema=schema_of("band int,cell int"))

    hist = np.zeros((len(BANDS), CELLS), np.int64)
    cells = (found.filter("token IS NOT NULL").select("token")
             .mapInArrow(test, "band int,cell int")
             .groupBy("band", "cell").agg(F.count(F.lit(1)).alias("n")))
    for r in cells.collect():  # at most bands x cells rows
        hist[r["band"], r["cell"]] = r["n"]
    return Null(letters, tuple(bh_cells(h, fdr) for h in hist))


def spans_of(text: str, null: Null) -> list[tuple[int, int, int, float | None]]:
    """All spans of a text: (start, kind number, end, p), sorted; p is None for
    pattern spans."""
    base = base_spans(text)
    out = [(s, k, e, None) for s, k, e in base]
    for s, e in candidates(text, base):
        p = p_value(text[s:e], null.letters)
        if cell_of(p) >= null.least[band_of(e - s)]:
            out.append((s, 3, e, p))
    out.sort(key=lambda x: x[:2])
    return out


_FOUND = "starts array<long>,kinds array<int>,ends array<long>,p array<double>"


def scan(docs: DataFrame, null: Null | None = None, fdr: float = FDR, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of (start,
    kind, end, p) sorted by start and kind; p is null for pattern spans."""
    null = calibrate(docs, fdr, text_col) if null is None else null
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        schema = schema_of("doc_id long," + _FOUND)
        for b in pieces(batches, "text"):
            rows = [spans_of(t, null) for t in texts(b)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array([[x[i] for x in r] for r in rows], f.type)
                                       for i, f in enumerate(list(schema)[1:]))], schema=schema)

    found = d.mapInArrow(run, "doc_id long," + _FOUND)
    return found.select("doc_id", F.transform(
        F.arrays_zip("starts", "kinds", "ends", "p"),
        lambda x: F.struct(x["starts"].alias("start"), x["kinds"].alias("kind"),
                           x["ends"].alias("end"), x["p"].alias("p"))).alias("spans"))


def masked_text(text: str, null: Null, mask: str) -> tuple[str, int]:
    """The text with every span, or run of overlapping spans, replaced; the
    number of replacements."""
    out, at, n = [], 0, 0
    end = -1
    for s, _, e, _ in spans_of(text, null):
        if s < end:
            end = max(end, e)
            continue
        if end >= 0:
            at = end
        out += [text[at:s], mask]
        end, n = e, n + 1
    return ("".join(out) + text[end:], n) if n else (text, 0)


def mask_rows(docs: DataFrame, mask: str, null: Null | None = None, fdr: float = FDR,
              text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` with the secrets of their texts replaced by
    ``mask``; texts without any, null ones too, and their rows stay as they
    are. ``length_col``, where there is one, follows the new text."""
    null = calibrate(docs, fdr, text_col) if null is None else null

    def make(ts):
        return zip(*[masked_text(t, null, mask) for t in ts])

    got = appended(docs, "new_text string,n_masked int", make, text_col)
    hit = F.col("n_masked") > 0
    old = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}
    changed = {text_col: F.when(hit, F.col("new_text")).otherwise(old[text_col])}
    if length_col in old:
        changed[length_col] = F.when(hit, F.char_length("new_text").cast(
            docs.schema[length_col].dataType)).otherwise(old[length_col])
    return restored(got, docs, **changed)


def listed(spans: str = "spans", below: int = len(KINDS)):
    """``kind:start:end`` of the spans whose kind number is below the bound,
    comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(
        F.filter(F.col(spans), lambda x: x["kind"] < below),
        lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"),
                              x["end"].cast("string"))), ",")


def count_of(kind: str, spans: str = "spans"):
    return F.size(F.filter(F.col(spans), lambda x: x["kind"] == KINDS.index(kind))).cast("long")
