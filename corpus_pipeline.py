"""Corpus pipeline: five stages over ``documents``, each calling one operator of
``barpanel.llm``. A stage takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and reread as the next stage's ``docs``; all but
the last return the columns of ``documents``.

1. quality rules: documents that the current policy rejects go;
2. SimHash near duplicates: of each group the document whose id is the
   component's stays, once;
3. secret scan: every span found is blanked by ``[secret]``; no document goes;
4. source mixing: no source is repeated more than twice as often as the least
   repeated one, and every document stays at least once; copies of a document
   are rows of their own. The rows are written in the order of the mix: a file
   holds a stretch of the mixed stream, in which the sources have their weights;
5. packing: pieces of 1024-token sequences, filled with documents in the order in
   which the files hold them (the order of whole files is the reader's).

SQL cannot express stages 2, 3 and 5 (bit-summed fingerprints, randomness tests,
tokenisation), so there is no ``ORACLE_SQL``; tests hold every stage against a
brute-force version.

Defined cases follow the operators. Rows with a null ``doc_id`` pass stages 1,
3, 4 and 5; in stage 2 such a row stays if no row of its group has an id, once
per distinct text. An empty table gives empty results. Texts of any length are
read whole by every stage; ties are settled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barpanel.llm.common import stored, table

MAX_REPEAT = 2.0
MASK = "[secret]"
#: Rows of documents in a batch that goes to Python: the session's default of
#: 10,000 holds tens of megabytes of text, several times over in a task.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the current policy keeps."""
    _small_batches(spark)
    from barpanel.llm.quality_rules import keep_rows
    return keep_rows(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document per group of near duplicates: the one with the
    smallest id, and of repeated rows of that id one."""
    _small_batches(spark)
    from barpanel.llm.simhash import keep_first
    return keep_first(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blanks the secrets in the texts; ``n_chars`` follows there."""
    _small_batches(spark)
    from barpanel.llm.secrets import mask_rows
    return mask_rows(docs, MASK)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mix, as often as the mix takes them and in its order: a file
    holds a stretch of the mixed stream, which packing reads as it stands."""
    from barpanel.llm.mixing import Target, in_order, mix
    return in_order(mix(docs, Target(max_repeat=MAX_REPEAT))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with the digest of their ids."""
    _small_batches(spark)
    from barpanel.llm.packing import pack
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs
