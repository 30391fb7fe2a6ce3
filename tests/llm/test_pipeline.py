import random

import corpus_pipeline
from barpanel.llm.quality_rules import RULES, measure_text
from tests.llm.helpers import docs, prose
from tests.llm.test_mixing import brute as mixed
from tests.llm.test_secrets import base
from tests.llm.test_simhash import brute as fingerprint
from tests.llm.test_simhash import components_of

F = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(9)
    texts = [prose(rng, rng.randint(60, 200)) for _ in range(40)]
    texts += [texts[0], texts[1] + " end", "too short", None, "", " ".join(["a b c"] * 50)]
    texts += [prose(rng, 70) + " password=abcdefghijklmnop " + prose(rng, 20) for _ in range(3)]
    source = ["src0"] * 30 + ["src1"] * (len(texts) - 31) + [None]
    return texts, source


def test_order_and_columns(spark):
    assert list(F) == ["quality_rules", "simhash_dedup", "secret_scan", "source_mixing", "packing"]
    texts, source = corpus()
    df = docs(spark, texts, source=source)
    for name, f in corpus_pipeline.STAGES[:-1]:
        assert f(spark, df, "").columns == COLUMNS, name


def test_quality_stage(spark):
    texts, source = corpus()
    got = {r.doc_id for r in F["quality_rules"](spark, docs(spark, texts, source=source), "").collect()}
    assert len(RULES) == 7
    want = {i for i, t in enumerate(texts) if (m := measure_text(t or ""))[0] >= 50
            and 100 * m[5] <= 50 * m[0]}
    assert got == want  # prose fails no other rule


def test_simhash_stage(spark):
    texts, source = corpus()
    got = F["simhash_dedup"](spark, docs(spark, texts, source=source), "").collect()
    want = components_of([(i, fingerprint(t)) for i, t in enumerate(texts)])
    assert sorted(r.doc_id for r in got) == sorted(set(want.values()))


def test_secret_stage(spark):
    texts, source = corpus()
    got = {r.doc_id: r for r in
           F["secret_scan"](spark, docs(spark, texts, source=source), "").collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want, shift = t, 0
        for s, _, e in base(t):
            want = want[:s + shift] + "[secret]" + want[e + shift:]
            shift += 8 - (e - s)
        assert got[i].text == want and got[i].n_chars == (None if t is None else len(want))


def test_mixing_stage(spark):
    texts, source = corpus()
    got = F["source_mixing"](spark, docs(spark, texts, source=source), "").collect()
    rows = [(i, s, len((t or "").split())) for i, (t, s) in enumerate(zip(texts, source))]
    from collections import Counter

    from barpanel.llm.mixing import Target, exponent
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    alpha = exponent(spark.createDataFrame([(n,) for n in sizes.values()], "tokens long"),
                     Target(max_repeat=2.0))
    want = Counter(k for k, _ in mixed(rows, None, alpha, 1 << 16))
    assert Counter(r.doc_id for r in got) == want and min(want.values()) >= 1


def test_odd_tables_run_through(spark):
    texts, source = corpus()
    odd = docs(spark, texts + texts[:3], [None, None, *range(len(texts) + 1)],
               source=source + [None] * 3, clash=True)
    for df in (odd, docs(spark, [])):
        for name, f in corpus_pipeline.STAGES:
            df = f(spark, df, "").persist()
            df.count()
        assert name == "packing"


def test_run(spark, tmp_path):
    texts, source = corpus()
    docs(spark, texts, source=source).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= set(range(len(texts)))
    sizes = {}
    for r in got:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
    order = [sizes[k] for k in range(len(sizes))]
    whole = sum(order) // 1024
    assert order[:whole] == [1024] * whole
    assert all(x & (x - 1) == 0 for x in order[whole:])


def test_packing_and_the_whole_run_against_brute_force(spark, tmp_path):
    """The run's pieces are those of the documents that brute force keeps, masks
    and repeats, cut as packing's brute force cuts them."""
    import zlib
    from collections import Counter

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from barpanel.llm.mixing import Target, exponent
    texts, source = corpus()
    texts.append(prose(random.Random(3), 30_000) + " <|endoftext|> end")  # over many sequences
    source.append("src1")
    docs(spark, texts, source=source, clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    kept = [i for i, t in enumerate(texts) if (m := measure_text(t or ""))[0] >= 50
            and 100 * m[5] <= 50 * m[0]]  # prose fails no other rule
    keep = sorted(set(components_of([(i, fingerprint(texts[i])) for i in kept]).values()))
    masked = {}
    for i in keep:
        t, shift = texts[i], 0
        for s, _, e in base(texts[i]):
            t, shift = t[:s + shift] + "[secret]" + t[e + shift:], shift + 8 - (e - s)
        masked[i] = t
    rows = [(i, source[i], len(masked[i].split())) for i in keep]
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    alpha = exponent(spark.createDataFrame([(n,) for n in sizes.values()], "tokens long"),
                     Target(max_repeat=2.0))
    times = Counter(keep[k] for k, _ in mixed(rows, None, alpha, 1 << 16))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: tokenizer.encode(masked[i], add_special_tokens=False).ids + [0] for i in keep}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    seen, sequences = {}, {}
    for r in got:
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(part) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        seen.setdefault(r.doc_id, Counter()).update(range(r.start, r.start + r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(seen) == set(keep)
    for i, c in seen.items():  # every id as often as the document is in the mix
        assert c == Counter({k: times[i] for k in range(len(ids[i]))})
    for s in sequences.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(s), sorted(s)[1:]))
