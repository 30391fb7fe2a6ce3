"""Mixing sources to target weights (operator 4), in DataFrame operations only.

*Temperature*: source shares p become weights proportional to ``p ** a``; the
exponent ``a`` in [0, 1] is found by bisection so that the weights reach a
target entropy, or so that no source is repeated more than ``max_repeat`` times
as often as the least repeated one.

*Realisation*: the budget times its weight is a source's quota of tokens. Its
documents are dealt into blocks of about ``block_tokens`` by a hash of the id;
every pass over the source takes the blocks in another hashed order and the
documents of a block likewise. The last pass ends inside a block, at a cut key.
A block's ``slot`` is the share of the quota that precedes it: rows sorted by
(slot, order key) are the mixed stream, in which each stretch of blocks holds
the target weights.

No group grows with a source: block totals are pre-aggregated, prefix sums run
over superblocks (4096 per source and pass), then over the blocks of one, and
documents are ordered only in the one block that a source's quota ends in.
Without a budget, the smallest one is taken that uses every document.

Defined cases: a null source is a source of its own; null and empty texts count
no token and join every pass of their block, at least one; documents of a
source without any token are taken once; a null ``doc_id`` hashes as the empty
text; a text of any length is read whole, and its block may be that much larger
than the others; equal ids (ties) share their order key, and at the cut they stay together;
repeated rows are rows of their own; an empty table gives an empty result; the
other columns of the input come back in ``mix``, but for columns that bear the
name of an added one (``ADDED``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barpanel.llm.common import WORD, stored

BLOCK_TOKENS = 1 << 16
STEPS = 50
SEED = "mix-1"


def tokens(text: str = "text") -> Column:
    """White-space separated words of a whole text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def key_of(source: str = "source") -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def _hex(c: Column) -> Column:
    """The first 48 bits of a hash as a number."""
    return F.conv(F.substring(F.md5(c), 1, 12), 16, 10).cast("long")


def _id(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


@dataclass(frozen=True)
class Target:
    """One of the two; entropy in nats."""
    entropy: float | None = None
    max_repeat: float | None = None


def exponent(sources: DataFrame, target: Target, steps: int = STEPS) -> float:
    """Bisects the exponent on the table of sources (``tokens`` > 0). Six
    halvings at a time share one aggregation of that small table, at all the
    exponents that they may ask for; only numbers come back. The larger exponent
    (closer to the corpus) is returned, so a repetition limit holds."""
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return 1.0
    lp = F.ln(F.col("tokens") / F.lit(float(total)))

    def flat_enough(at: list[float]) -> dict[float, bool]:
        """Whether the weights at each exponent are at least as flat as the target."""
        rows = sources.select(lp.alias("lp"), F.explode(F.array(*map(F.lit, at))).alias("a"))
        if target.max_repeat is not None:
            r = F.exp((F.col("a") - 1.0) * F.col("lp"))
            got = rows.groupBy("a").agg((F.max(r) / F.min(r)).alias("r")).collect()
            return {x["a"]: x["r"] > target.max_repeat for x in got}
        w = F.exp(F.col("a") * F.col("lp"))
        got = rows.groupBy("a").agg(F.sum(w).alias("z"), F.sum(w * F.col("lp")).alias("s")).collect()
        return {x["a"]: math.log(x["z"]) - x["a"] * x["s"] / x["z"] >= target.entropy for x in got}

    lo, hi = 0.0, 1.0  # flat at lo, not at hi
    ends = flat_enough([lo, hi])
    if ends[hi]:
        return hi
    if not ends[lo]:
        return lo
    while steps > 0:
        bits = min(steps, 6)
        steps -= bits
        step = (hi - lo) / 2 ** bits  # exact: a power of two
        known = flat_enough([lo + k * step for k in range(1, 2 ** bits)])
        for _ in range(bits):
            mid = (lo + hi) / 2
            if known[mid]:
                lo = mid
            else:
                hi = mid
    return hi


def weigh(sources: DataFrame, target: Target, budget: int | None = None,
          steps: int = STEPS) -> DataFrame:
    """Adds ``weight`` (they sum to 1) and ``quota`` (tokens) to sources."""
    full = sources.filter("tokens > 0")
    a = exponent(full, target, steps)
    total = float(full.agg(F.sum("tokens")).first()[0] or 1)
    w = F.when(F.col("tokens") > 0, F.exp(F.lit(a) * F.ln(F.col("tokens") / F.lit(total)))
               ).otherwise(F.lit(0.0))
    z = sources.agg(F.sum(w)).first()[0] or 1.0
    out = sources.withColumn("weight", w / F.lit(z))
    if budget is None:
        size = out.filter("weight > 0").agg(F.max(F.col("tokens") / F.col("weight"))).first()[0]
        budget_ = 0.0 if size is None else float(size)
    else:
        budget_ = float(budget)
    return out.withColumn("quota", F.round(F.col("weight") * F.lit(budget_)).cast("long"))


def plan(docs: DataFrame, target: Target, budget: int | None = None,
         block_tokens: int = BLOCK_TOKENS, seed: str = SEED, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The table of sources (weights, quotas, blocks) and the table of passes:
    one row per source, pass and block taken, with its slot and, where the
    quota ends in it, the cut key. Both are written: the input is read for the
    token counts once."""
    slim = stored(docs.select(key_of(source_col).alias("source_key"), _id(id_col).alias("id"),
                              tokens(text_col).alias("tokens")))
    totals = stored(slim.groupBy("source_key").agg(F.sum("tokens").alias("tokens"),
                                                   F.count(F.lit(1)).alias("docs")))
    sources = stored(weigh(totals, target, budget).withColumn(
        "blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(block_tokens))).cast("long")))

    dealt = slim.join(sources.select("source_key", "blocks"), "source_key").withColumn(
        "block", block_of(F.col("id"), F.col("blocks"), seed))
    blocks = dealt.groupBy("source_key", "block").agg(F.sum("tokens").alias("block_tokens"))

    # every pass that the quota begins; sources without tokens have one
    quota, whole = F.col("quota"), F.col("source_tokens")
    last = F.when(whole > 0, F.ceil(quota / whole) - 1).otherwise(F.lit(0)).cast("int")
    passes = (blocks.join(sources.select("source_key", "quota", F.col("tokens").alias("source_tokens")),
                          "source_key")
              .filter((quota > 0) | (whole == 0))
              .withColumn("pass", F.explode(F.sequence(F.lit(0), last)))
              .withColumn("left", quota - F.col("pass") * whole)
              .withColumn("order", F.md5(F.concat_ws("|", "source_key", "pass", "block", F.lit(seed))))
              .withColumn("super", F.substring("order", 1, 3)))
    passes = stored(passes)
    of_pass = ["source_key", "pass"]
    ahead = (Window.partitionBy(*of_pass).orderBy("super")
             .rowsBetween(Window.unboundedPreceding, -1))
    supers = (passes.groupBy(*of_pass, "super").agg(F.sum("block_tokens").alias("n"))
              .select(*of_pass, "super", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base")))
    within = (Window.partitionBy(*of_pass, "super").orderBy("order", "block")
              .rowsBetween(Window.unboundedPreceding, -1))
    passes = (passes.join(supers, [*of_pass, "super"])
              .withColumn("before", F.col("base") + F.coalesce(
                  F.sum("block_tokens").over(within), F.lit(0)))
              .filter((F.col("before") < F.col("left")) | (whole == 0)
                      | ((F.col("block_tokens") == 0) & (F.col("pass") == 0))))
    passes = stored(passes)

    # the block that the quota ends in: documents are taken while the tokens
    # before them are fewer than what is left
    ends = (passes.filter(F.col("before") + F.col("block_tokens") > F.col("left"))
            .select(*of_pass, "block", (F.col("left") - F.col("before")).alias("room")))
    inside = (dealt.join(ends, ["source_key", "block"])
              .withColumn("key", order_key(F.col("id"), F.col("pass"), seed)))
    keys = inside.groupBy(*of_pass, "block", "key").agg(F.sum("tokens").alias("n"),
                                                       F.first("room").alias("room"))
    by_key = Window.partitionBy(*of_pass, "block").orderBy("key").rowsBetween(
        Window.unboundedPreceding, -1)
    cuts = (keys.withColumn("ahead", F.coalesce(F.sum("n").over(by_key), F.lit(0)))
            .filter("ahead < room").groupBy(*of_pass, "block").agg(F.max("key").alias("cut")))
    slot = F.when(whole > 0, (F.col("pass") * whole + F.col("before")) / quota).otherwise(F.lit(0.0))
    taken = passes.join(cuts, [*of_pass, "block"], "left").select(
        "source_key", "block", "pass", slot.alias("slot"), "cut")
    return sources, stored(taken)


def block_of(id_: Column, blocks: Column, seed: str) -> Column:
    return _hex(F.concat_ws("|", id_, F.lit(seed))) % blocks


def order_key(id_: Column, pass_: Column, seed: str) -> Column:
    """Order of the documents of a block in a pass."""
    return F.md5(F.concat_ws("|", id_, pass_, F.lit(seed)))


ADDED = ("mix_weight", "mix_pass", "mix_block", "mix_slot", "mix_key")


def mix(docs: DataFrame, target: Target, budget: int | None = None,
        block_tokens: int = BLOCK_TOKENS, seed: str = SEED, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed rows: the input's columns, each row once per pass that takes
    it, and ``mix_weight``, ``mix_pass``, ``mix_block``, ``mix_slot`` and
    ``mix_key``, the order within equal slots."""
    sources, taken = plan(docs, target, budget, block_tokens, seed, id_col, text_col, source_col)
    sources = sources.select(F.col("source_key").alias("mix_source"),
                             F.col("weight").alias("mix_weight"), "blocks")
    taken = taken.select(F.col("source_key").alias("mix_source"), F.col("block").alias("mix_block"),
                         F.col("pass").alias("mix_pass"), F.col("slot").alias("mix_slot"), "cut")
    cols = [F.col("`" + c.replace("`", "``") + "`").alias(c) for c in docs.columns
            if c not in ADDED]
    d = docs.select(F.struct(*cols).alias("row"), _id(id_col).alias("id"),
                    key_of(source_col).alias("mix_source"))
    key = order_key(F.col("id"), F.col("mix_pass"), seed)
    got = (d.join(sources, "mix_source")
           .withColumn("mix_block", block_of(F.col("id"), F.col("blocks"), seed))
           .join(taken, ["mix_source", "mix_block"])
           .withColumn("mix_key", key)
           .filter(F.col("cut").isNull() | (F.col("mix_key") <= F.col("cut"))))
    return got.select("row.*", "mix_weight", "mix_pass", "mix_block", "mix_slot", "mix_key")


def in_order(mixed: DataFrame, parts: int | None = None) -> DataFrame:
    """The rows of :func:`mix` dealt into ``parts`` partitions that hold consecutive
    stretches of the mixed stream, each sorted, so that files written from them
    hold the target weights each and readers of a file see the mixed order. A
    slot's share of the stream is known, so no sample is drawn."""
    n = parts or int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    at = F.least(F.floor(F.col("mix_slot") * n), F.lit(n - 1)).cast("int")
    return mixed.repartitionById(n, at).sortWithinPartitions("mix_slot", "mix_key")
