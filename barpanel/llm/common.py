"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barpanel.session import ensure_checkpoint_dir

#: The six ASCII white-space characters that separate words.
SPACES = " \t\n\x0b\x0c\r"

#: Words of a text, as a Java / RE2 pattern.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- results that must not be recomputed ---------------------------------------

def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut: a lost
    executor re-reads the files. Spark removes them with the DataFrame."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_written: list[tuple[SparkSession, str]] = []


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """As :func:`cut`, but column-wise and compressed, for wide or large
    intermediate tables. Removed when the driver process ends, because the
    lazy result of an operator may still read it until then."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_remove)
    _written.append((spark, path))
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove() -> None:
    for spark, path in _written:
        try:
            sc = spark.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session may have been stopped already
            return


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str = "doc_id") -> DataFrame:
    """The documents that have a row in ``labels``; beyond ``max_rows`` labels, of
    a sample of about so many, drawn by a hash of the id. The drawn labels go to
    every task, once their number has been checked, so no document is shuffled."""
    total = labels.count()
    if total > max_rows:
        labels = labels.filter(drawn_by(F.col(id_col)) < max_rows / total * 2 ** 32)
    if labels.count() <= 2 * max_rows:
        labels = F.broadcast(labels)
    return docs.join(labels, id_col)


def drawn_by(id_: Column) -> Column:
    """A number in [0, 2^32) drawn for an id; samples of different sizes nest."""
    text = F.coalesce(id_.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")


# -- Arrow batches in tasks -----------------------------------------------------

def schema_of(ddl: str) -> pa.Schema:
    """Arrow schema of a flat ``name type`` list: long, int, double, string,
    boolean, binary and arrays of them."""
    flat = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
            "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}

    def kind(t):
        return pa.list_(kind(t[6:-1])) if t.startswith("array<") else flat[t]
    return pa.schema([(n, kind(t)) for n, t in (x.split() for x in ddl.split(","))])


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = 8 << 20,
           ) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold at most ``limit`` bytes of a string or
    binary column each, or a single row: bounds what a task handles at once."""
    for b in batches:
        col = b.column(b.schema.get_field_index(column))
        if b.num_rows == 0:
            continue
        sizes = np.array([0 if x is None else x for x in
                          pa.compute.binary_length(col).to_pylist()], np.int64)
        part = np.cumsum(sizes) // max(1, limit)
        cuts = np.flatnonzero(np.diff(part)) + 1
        for s, e in zip(np.r_[0, cuts], np.r_[cuts, b.num_rows]):
            if e > s:
                yield b.slice(int(s), int(e - s))


def texts(b: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's values; null is the empty text."""
    return ["" if t is None else t for t in b.column(column).to_pylist()]


def appended(docs: DataFrame, added: str, make, text_col: str = "text") -> DataFrame:
    """Whole rows with columns added that ``make`` finds for a list of texts, a
    column each. The input's columns come as ``c0``, ``c1``, ... under the new
    ones, whatever their names were; :func:`restored` names them again."""
    n = len(docs.columns)
    schema = StructType(docs.toDF(*[f"c{i}" for i in range(n)]).schema.fields)
    new = schema_of(added)
    for f in StructType.fromDDL(added):
        schema = schema.add(f)
    text = f"c{docs.columns.index(text_col)}"

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text):
            got = make(texts(b, text))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(x, f.type) for x, f in zip(got, new))],
                names=[*b.schema.names, *new.names])

    return docs.toDF(*[f"c{i}" for i in range(n)]).mapInArrow(run, schema)


def restored(df: DataFrame, like: DataFrame, **changed) -> DataFrame:
    """The columns of ``like`` out of :func:`appended`'s; ``changed`` ones anew."""
    return df.select(*[changed.get(c, F.col(f"c{i}")).alias(c)
                       for i, c in enumerate(like.columns)])


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by integer ``keys``: the
    open last group of a batch waits for the next one."""
    open_: list[pa.Table] = []
    for b in batches:
        if b.num_rows == 0:
            continue
        t = pa.Table.from_batches([b])
        cols = [t.column(k).to_numpy() for k in keys]
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols]))
        if open_:
            last = open_[-1]
            same = all(last.column(k)[-1].as_py() == t.column(k)[0].as_py() for k in keys)
            if same and not change.size:
                open_.append(t)
                continue
            if not same:
                yield pa.concat_tables(open_)
                open_ = []
        if change.size:
            at = int(change[-1]) + 1
            yield pa.concat_tables([*open_, t.slice(0, at)])
            open_ = [t.slice(at)]
        else:
            open_.append(t)
    if open_:
        yield pa.concat_tables(open_)


def starts_of(*cols: np.ndarray) -> np.ndarray:
    """Positions where sorted key columns change, 0 first, the length last."""
    n = len(cols[0])
    if n == 0:
        return np.zeros(1, np.int64)
    new = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    return np.r_[0, np.flatnonzero(new) + 1, n]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each range, one after another."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)


def id_text(col: str = "doc_id"):
    return F.col(col).cast("string")
