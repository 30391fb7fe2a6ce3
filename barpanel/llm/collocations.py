"""Phrase collocations by stripes (operator 11).

A *stripe* is a prefix with an associative counter of the words that follow it.
One pass over the texts counts the stripes of all prefixes of no word and of two
words (the end of a piece counts as a follower of two words), batch by batch.
Stripes of the same prefix are merged elementwise, and the merged structure
gives all the numbers of the mining:

* the stripe of no word holds every word's count; its total is ``n``;
* the total of the stripe of (u, v) is f(u v), its entries are f(u v w);
* the largest entry of the stripe of (u, v) is the largest three-word phrase
  that starts with u v; the one that ends with u v is a maximum over merged
  entries.

*Movement.* A batch's stripes travel as compressed blocks, one per language and
bucket. A bucket is a hash of the prefix, so that a stripe meets its like in one
place; the stripe of no word, and the stripes of the few word pairs that a
sample shows in over 1/1024 of all places, are dealt by prefix and follower, so
that no bucket holds a hot stripe (the sample decides only where entries are
counted, never what). Buckets are as many as the bytes of the texts call for.
A bucket is merged as its blocks arrive, in memory bounded by its distinct
entries. Only numbers of phrases with ``least`` occurrences leave it, to be
joined by word and pair.

Defined cases: a null text is empty and has no word; a null language is
``und``; a text of any length is read whole, a very long one in parts that
end at piece ends, since no phrase crosses them; repeated rows count again, each; equal
scores are ordered by count, then by the phrase's UTF-8 bytes, and no two
phrases of a language are equal; an empty table gives an empty result; a null
``doc_id`` does not matter and other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barpanel.llm.common import pieces, schema_of, stored

LEAST = 10
TOP = 2000
#: Bytes of text whose stripes share a bucket (on average), and that a task
#: counts at once.
BUCKET_BYTES = 8 << 20
CHUNK_BYTES = 4 << 20
#: Pairs in more than one of so many places are dealt by follower.
HOT_SHARE = 1024
#: One of so many documents is looked at for such pairs.
SAMPLE = 64
#: Tasks that rank a language's phrases before their leaders meet.
SPREAD = 64

_PIECE_END = re.compile(r"[.,;:!?\n\x0b\x0c\r]")
_M1, _M2, _M3 = (np.uint64(x) for x in
                 (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _parts(text: str, limit: int) -> Iterator[str]:
    """A text cut after piece ends, into parts of about ``limit`` characters."""
    at = 0
    while len(text) - at > limit:
        end = _PIECE_END.search(text, at + limit)
        if end is None:
            break
        yield text[at:end.end()]
        at = end.end()
    yield text[at:]


class Places:
    """The words of a batch of texts in order. ``word`` numbers them in
    ``words``; ``second`` and ``third`` are the numbers of the words that
    follow in the same piece, -1 beyond its end."""

    def __init__(self, texts: list[str], langs: np.ndarray, limit: int = CHUNK_BYTES):
        of = langs
        if any(len(t) > limit for t in texts):
            cut = [(p, k) for t, k in zip(texts, langs) for p in _parts(t, limit)]
            texts, of = [p for p, _ in cut], np.array([k for _, k in cut], np.int64)
        lower = pc.ascii_lower(pa.array(texts, pa.large_string()))
        split = pc.split_pattern_regex(lower, r"[.,;:!?\n\x0b\x0c\r]")
        piece_lang = np.asarray(of)[pc.list_parent_indices(split).to_numpy()]
        split = pc.split_pattern_regex(pc.list_flatten(split), "[ \t]+")
        coded = pc.list_flatten(split).dictionary_encode()
        word, piece = coded.indices.to_numpy(), pc.list_parent_indices(split).to_numpy()
        full = pc.greater(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)
        keep = full[word] if len(word) else np.zeros(0, bool)
        self.words = coded.dictionary
        self.word, piece = word[keep].astype(np.int64), piece[keep]
        self.lang = piece_lang[piece] if len(piece) else np.zeros(0, np.int64)
        n = len(self.word)
        self.second, self.third = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        for step, out in ((1, self.second), (2, self.third)):
            same = np.flatnonzero(piece[step:] == piece[:n - step]) if n > step else []
            out[same] = self.word[step:][same]

    def hashes(self) -> np.ndarray:
        """A hash of each word, and of the end of a piece at index -1."""
        h = xxhash.xxh64_intdigest
        return np.array([h(w) for w in self.words.to_pylist()] + [0], np.uint64)


def _mix(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[-1]), np.uint64)
    for x, m in zip(parts, (_M1, _M2, _M3)):
        h = (h ^ x) * m
        h ^= h >> np.uint64(29)
    return h


def stripes(p: Places, buckets: int, hot: list[tuple[int, str, str]],
            ) -> Iterator[tuple[int, int, bytes]]:
    """Blocks (language number, bucket, block) of a batch's counted stripes."""
    if not len(p.word):
        return
    v = len(p.words) + 1
    pair = ((p.lang * v + p.word) * v + p.second)[p.second >= 0]
    third = p.third[p.second >= 0]
    keys, pair = np.unique(pair, return_inverse=True)
    entries, count = np.unique(pair * v + third + 1, return_counts=True)
    pair, third = entries // v, entries % v - 1
    lang, first, second = keys // v // v, keys // v % v, keys % v
    single, n_single = np.unique(p.lang * v + p.word, return_counts=True)
    # all entries: the stripe of no word (first and second at -1), then the pairs
    lang = np.r_[single // v, lang[pair]]
    first = np.r_[np.full(len(single), -1), first[pair]]
    second = np.r_[np.full(len(single), -1), second[pair]]
    follower, count = np.r_[single % v, third], np.r_[n_single, count]
    h = p.hashes()
    by_follower = first < 0
    if hot:
        where = {w: i for i, w in enumerate(p.words.to_pylist())}
        for k, a, b in hot:
            if a in where and b in where:
                by_follower |= (lang == k) & (first == where[a]) & (second == where[b])
    dealt = _mix(h[first], h[second], np.where(by_follower, h[follower], np.uint64(0)))
    bucket = (dealt >> np.uint64(16)) % np.uint64(buckets)
    order = np.lexsort((second, first, bucket, lang))
    lang, bucket, first, second, follower, count = (
        x[order] for x in (lang, bucket, first, second, follower, count))
    # a line per stripe: first TAB second TAB follower TAB follower ...
    word = pa.concat_arrays([p.words, pa.array([""], pa.large_string())])
    new = np.r_[True, (np.diff(lang) != 0) | (np.diff(bucket) != 0) | (np.diff(first) != 0)
                | (np.diff(second) != 0)]
    blank = len(word) - 1
    at = np.where(new, first, -1), np.where(new, second, -1)
    tabs = pa.array(["", "\t"], pa.large_string()).take(pa.array(new.astype(np.int64)))
    ends = pa.array(["\t", "\n"], pa.large_string()).take(
        pa.array(np.r_[new[1:], True].astype(np.int64)))

    def named(x):
        return word.take(pa.array(np.where(x < 0, blank, x)))
    lines = pc.binary_join_element_wise(named(at[0]), tabs, named(at[1]), tabs, named(follower),
                                        ends, pa.scalar("", pa.large_string()))
    offsets = np.frombuffer(lines.buffers()[1], np.int64, len(lines) + 1, lines.offset * 8)
    data = memoryview(lines.buffers()[2])
    group = np.r_[np.flatnonzero(np.r_[True, (np.diff(lang) != 0) | (np.diff(bucket) != 0)]),
                  len(lang)]
    pack = zstandard.ZstdCompressor(level=1).compress
    small = count.astype("<u4") if count.max() < 1 << 32 else None
    for s, e in zip(group[:-1], group[1:]):
        if small is None:
            raise OverflowError("a batch of texts holds 2**32 words")
        head = int(e - s).to_bytes(8, "little")
        yield int(lang[s]), int(bucket[s]), pack(
            head + small[s:e].tobytes() + bytes(data[offsets[s]:offsets[e]]))


class Stripes:
    """Merged stripes: entries sorted by (first, second, follower)."""

    def __init__(self):
        self.waiting: list[bytes] = []
        self.size = 0
        self.table: pa.Table | None = None

    def add(self, block: bytes, limit: int = 16 << 20) -> None:
        self.waiting.append(zstandard.ZstdDecompressor().decompress(block))
        self.size += len(self.waiting[-1])
        if self.size > limit:
            self.merge()

    def merge(self) -> None:
        """Adds the waiting blocks elementwise."""
        tables = [] if self.table is None else [self.table]
        if self.waiting:
            sizes = [int.from_bytes(raw[:8], "little") for raw in self.waiting]
            count = np.concatenate([np.frombuffer(raw, "<u4", n, 8)
                                    for raw, n in zip(self.waiting, sizes)]).astype(np.int64)
            text = b"".join(raw[8 + 4 * n:] for raw, n in zip(self.waiting, sizes))[:-1]
            whole = pa.LargeStringArray.from_buffers(
                1, pa.py_buffer(np.array([0, len(text)], np.int64)), pa.py_buffer(text))
            lines = pc.split_pattern(pc.list_flatten(pc.split_pattern(whole, "\n")), "\t")
            at = np.asarray(lines.offsets)
            flat = lines.flatten().dictionary_encode()
            ids = flat.indices.to_numpy()
            per = np.diff(at) - 2
            is_follower = np.ones(len(ids), bool)
            is_follower[at[:-1]] = is_follower[at[:-1] + 1] = False
            cols = [np.repeat(ids[at[:-1]], per), np.repeat(ids[at[:-1] + 1], per), ids[is_follower]]
            tables.append(pa.table([*(pa.DictionaryArray.from_arrays(pa.array(c, pa.int32()),
                                                                    flat.dictionary) for c in cols),
                                    pa.array(count)], ["first", "second", "follower", "count"]))
        self.waiting, self.size = [], 0
        if not tables:
            return
        t = pa.concat_tables(tables).unify_dictionaries()
        # one dictionary for the three columns, so that numbers can be compared
        words = pa.concat_arrays([c.chunk(0).dictionary for c in t.columns[:3]])
        words = words.dictionary_encode()
        moved, at = words.indices.to_numpy(), 0
        ids = []
        for c in t.columns[:3]:
            own = len(c.chunk(0).dictionary)
            ids.append(moved[at:at + own][np.concatenate([x.indices.to_numpy() for x in c.chunks])])
            at += own
        a, b, c = (x.astype(np.int64) for x in ids)
        v = len(words.dictionary)
        keys, pair = np.unique(a * v + b, return_inverse=True)
        entries, where = np.unique(pair * v + c, return_inverse=True)
        sums = np.zeros(len(entries), np.int64)
        np.add.at(sums, where, t.column("count").to_numpy())
        cols = [keys[entries // v] // v, keys[entries // v] % v, entries % v]
        self.table = pa.table([*(pa.DictionaryArray.from_arrays(pa.array(x, pa.int32()),
                                                                words.dictionary) for x in cols),
                               pa.array(sums)], ["first", "second", "follower", "count"])

    def numbers(self, lang: str, least: int, hot: set[tuple[str, str, str]]) -> pa.Table | None:
        """What leaves the bucket: the words' total (kind 0), words (1), pairs
        with their largest extension (2) and triples (3)."""
        self.merge()
        if self.table is None:
            return None
        first, second, follower = (c.chunk(0) for c in self.table.columns[:3])
        words = pa.concat_arrays([first.dictionary, pa.array([""], pa.large_string())])
        count = self.table.column("count").to_numpy()
        a, b, c = (x.indices.to_numpy() for x in (first, second, follower))
        empty = pc.index(words, "").as_py()
        none = (a == empty) & (b == empty)
        out = []

        def rows(kind, x, y, z, n, longest):
            def named(ids):
                return words.take(pa.array(ids)).cast(pa.string())
            k = len(n)
            out.append(pa.table([
                pa.array(np.full(k, kind, np.int32)), pa.array([lang] * k, pa.string()),
                named(x), named(y), named(z), pa.array(n), pa.array(longest)], schema=_NUMBERS))
        if none.any():
            one = np.array([empty])
            rows(0, one, one, one, np.array([count[none].sum()]), np.zeros(1, np.int64))
            k = np.flatnonzero(none & (count >= least))
            at = np.full(len(k), empty)
            rows(1, c[k], at, at, count[k], np.zeros(len(k), np.int64))
        k = np.flatnonzero(~none)
        if k.size:
            a, b, c, count = a[k], b[k], c[k], count[k]
            s = np.flatnonzero(np.r_[True, (np.diff(a) != 0) | (np.diff(b) != 0)])
            total = np.add.reduceat(count, s)
            longest = np.maximum.reduceat(np.where(c == empty, 0, count), s)
            keep = total >= least
            if hot:  # their stripes are spread: totals are parts
                keep |= np.array([(lang, x, y) in hot for x, y in zip(
                    words.take(pa.array(a[s])).to_pylist(), words.take(pa.array(b[s])).to_pylist())])
            s, total, longest = s[keep], total[keep], longest[keep]
            rows(2, a[s], b[s], np.full(len(s), empty), total, longest)
            k = np.flatnonzero((count >= least) & (c != empty))
            rows(3, a[k], b[k], c[k], count[k], np.zeros(len(k), np.int64))
        return pa.concat_tables(out)


_NUMBERS = schema_of("kind int,lang string,first string,second string,third string,f long,longest long")
_NUMBERS_DDL = "kind int,lang string,first string,second string,third string,f long,longest long"


def _chunks(batches, limit: int):
    """Languages by number, and places, of whole batches of texts."""
    for b in pieces(batches, "text", limit):
        langs = b.column("lang").dictionary_encode()
        texts = ["" if t is None else t for t in b.column("text").to_pylist()]
        yield langs.dictionary.to_pylist(), Places(texts, langs.indices.to_numpy().astype(np.int64),
                                                   limit)
        pa.default_memory_pool().release_unused()


def hot_pairs(docs: DataFrame, one_of: int = SAMPLE, share: int = HOT_SHARE) -> list[tuple]:
    """(language, word, word) of the pairs that make up more than one in
    ``share`` of a sample's places: at most ``share`` of them. A hint for dealing."""
    def count(batches) -> Iterator[pa.RecordBatch]:
        for langs, p in _chunks(batches, CHUNK_BYTES):
            v, inside = len(p.words) + 1, p.second >= 0
            if not inside.any():
                continue
            key, n = np.unique(((p.lang * v + p.word) * v + p.second)[inside], return_counts=True)
            k = np.flatnonzero(n * share >= n.sum())
            words = p.words
            yield pa.RecordBatch.from_arrays([
                pa.array([None, *(langs[x] for x in key[k] // v // v)], pa.string()),
                pa.concat_arrays([pa.array([None], pa.string()),
                                  words.take(pa.array(key[k] // v % v)).cast(pa.string())]),
                pa.concat_arrays([pa.array([None], pa.string()),
                                  words.take(pa.array(key[k] % v)).cast(pa.string())]),
                pa.array(np.r_[n.sum(), n[k]])],
                schema=schema_of("lang string,first string,second string,n long"))

    got = (docs.filter(F.pmod(F.xxhash64("text"), F.lit(one_of)) == 0)
           .mapInArrow(count, "lang string,first string,second string,n long")
           .groupBy("lang", "first", "second").agg(F.sum("n").alias("n")))
    all_, = got.filter("first IS NULL").agg(F.sum("n")).first()
    if not all_:
        return []
    return sorted((r["lang"], r["first"], r["second"]) for r in
                  got.filter(F.col("first").isNotNull() & (F.col("n") * share > F.lit(all_)))
                  .limit(share).collect())


def count_stripes(docs: DataFrame, least: int = LEAST, lang_col: str = "lang",
                  text_col: str = "text", bucket_bytes: int = BUCKET_BYTES,
                  chunk_bytes: int = CHUNK_BYTES, sample: int = SAMPLE) -> DataFrame:
    """The merged stripes' numbers: rows (kind, lang, first, second, third, f,
    longest) of words, pairs and triples with at least ``least`` occurrences
    and, as kind 0, parts of each language's number of words."""
    d = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                    F.col(text_col).alias("text")).filter("text IS NOT NULL")
    total = d.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-int(total) // bucket_bytes))
    hot = hot_pairs(d, sample)

    def spread(batches) -> Iterator[pa.RecordBatch]:
        out = schema_of("lang string,bucket long,block binary")
        for langs, p in _chunks(batches, chunk_bytes):
            number = {x: i for i, x in enumerate(langs)}
            own = [(number[k], a, b) for k, a, b in hot if k in number]
            rows, size = [], 0
            for k, bucket, block in stripes(p, buckets, own):
                rows.append((langs[k], bucket, block))
                size += len(block)
                if size > 4 << 20:
                    yield _batch(rows, out)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, out)

    hot_set = set(hot)

    def merged(batches) -> Iterator[pa.RecordBatch]:
        at, open_ = None, Stripes()

        def closed():
            t = open_.numbers(at[0], least, hot_set)
            yield from t.to_batches() if t is not None else ()
        for b in batches:
            for lang, bucket, block in zip(*(b.column(i).to_pylist() for i in range(3))):
                if (lang, bucket) != at:
                    if at is not None:
                        yield from closed()
                    at, open_ = (lang, bucket), Stripes()
                open_.add(block)
        if at is not None:
            yield from closed()

    return (d.mapInArrow(spread, "lang string,bucket long,block binary")
            .repartition("lang", "bucket").sortWithinPartitions("lang", "bucket")
            .mapInArrow(merged, _NUMBERS_DDL))


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def candidates(numbers: DataFrame, least: int = LEAST) -> DataFrame:
    """All candidates (lang, phrase, a, l, r, n, score), those inside a longer
    one left out. Numbers are exact: products are 38-digit decimals."""
    n = numbers.filter("kind = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    words = numbers.filter("kind = 1").select("lang", F.col("first").alias("w"), "f")
    pairs = (numbers.filter("kind = 2").groupBy("lang", "first", "second")
             .agg(F.sum("f").alias("a"), F.max("longest").alias("after"))
             .filter(F.col("a") >= least)
             .withColumn("after", F.when(F.col("after") >= least, F.col("after")).otherwise(0)))
    triples = numbers.filter("kind = 3").select("lang", "first", "second", "third",
                                                F.col("f").alias("a"))
    before = (triples.groupBy("lang", F.col("second").alias("first"), F.col("third").alias("second"))
              .agg(F.max("a").alias("before")))

    def word(as_, f):
        return words.select("lang", F.col("w").alias(as_), F.col("f").alias(f))

    def pair(x, y, f):
        return pairs.select("lang", F.col("first").alias(x), F.col("second").alias(y),
                            F.col("a").alias(f))

    def score(left, right):
        # a <= l and a <= r, so the quotient is at most 1000000
        big = "cast({} as decimal(19,0))".format
        return F.expr(f"(cast(1000000 as decimal(7,0)) * ({big('a')} * {big('a')})) "
                      f"div ({big(left)} * {big(right)})")

    two = (pairs.join(before, ["lang", "first", "second"], "left")
           .filter(100 * F.greatest("after", F.coalesce("before", F.lit(0))) < 50 * F.col("a"))
           .join(word("first", "l"), ["lang", "first"]).join(word("second", "r"), ["lang", "second"])
           .select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a", "l", "r",
                   score("l", "r").alias("score")))
    three = (triples.join(pair("first", "second", "l2"), ["lang", "first", "second"])
             .join(pair("second", "third", "r1"), ["lang", "second", "third"])
             .join(word("first", "l1"), ["lang", "first"]).join(word("third", "r2"), ["lang", "third"])
             .withColumn("s1", score("l1", "r1")).withColumn("s2", score("l2", "r2"))
             .withColumn("early", F.col("s1") <= F.col("s2"))
             .select("lang", F.concat_ws(" ", "first", "second", "third").alias("phrase"), "a",
                     F.when(F.col("early"), F.col("l1")).otherwise(F.col("l2")).alias("l"),
                     F.when(F.col("early"), F.col("r1")).otherwise(F.col("r2")).alias("r"),
                     F.least("s1", "s2").alias("score")))
    return two.unionByName(three).join(n, "lang").select(
        "lang", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, **how) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r,
    n, score."""
    numbers = stored(count_stripes(docs, least, **how))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # a language's phrases are ranked in SPREAD tasks first, whose leaders meet
    some, all_ = (Window.partitionBy(*k).orderBy(*order) for k in (("lang", "share"), ("lang",)))
    leaders = (candidates(numbers, least)
               .withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
               .withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top))
    return (leaders.withColumn("rank", F.row_number().over(all_)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                    "score"))
