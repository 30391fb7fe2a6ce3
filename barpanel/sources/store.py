"""Panel stores whose keys are replaced one by one.

A write goes aside, into a generation folder of its own
(``gen=w<id>/ticker=.../split=...``), which no reader looks at. It is published
by one small file, moved whole into ``_log``; from then on its partitions stand
for those of the same key in earlier generations, all at once. So

* rewriting one ticker leaves every other ticker's files as they are;
* a write that fails, or a driver that dies before the publication, leaves the
  store as it was;
* a reader plans with one state of the log and never sees a part of a write.
  The replaced files stay until :meth:`PanelStore.vacuum`, so a plan made
  before a publication can still be read after it.

Writers of different keys do not disturb each other. Of two writers of one key,
the later in the log counts (with equal numbers, the greater id). The driver
lists folders, as a file scan does anyway; rows never pass it.
"""

from __future__ import annotations

import json
import time
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_NULL_DIR = "__HIVE_DEFAULT_PARTITION__"


class PanelStore:
    """A folder of partitions by ``keys``. ``fmt`` and ``options`` are those of
    Spark's writer; a text format (CSV) is read back with the schema written."""

    def __init__(self, spark: SparkSession, path: str, keys=("ticker",), fmt: str = "parquet",
                 **options):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), tuple(keys)
        self.fmt, self.options = fmt, options
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration())

    # -- writing ---------------------------------------------------------------
    def write(self, df: DataFrame) -> str:
        """Replaces the partitions of the keys that ``df`` holds; its id."""
        missing = [k for k in self.keys if k not in df.columns]
        if missing:
            raise ValueError(f"the store is keyed by {list(self.keys)}; missing {missing}")
        gen = f"w{uuid.uuid4().hex}"
        target = f"{self.path}/gen={gen}"
        try:
            # a key's rows share files; a hot key is split among tasks
            (df.hint("rebalance", *self.keys).write.format(self.fmt).options(**self.options)
             .partitionBy(*self.keys).save(target))
            self._publish(gen, df.schema)
        except BaseException:
            self._fs.delete(self._Path(target), True)
            raise
        return gen

    def _publish(self, gen: str, schema: StructType) -> None:
        aside, log = f"{self.path}/_aside/{gen}", self._Path(f"{self.path}/_log")
        out = self._fs.create(self._Path(aside), True)
        try:
            out.write(bytearray(schema.json().encode()))
        finally:
            out.close()
        self._fs.mkdirs(log)
        number = 1 + max((n for n, _ in self._log()), default=0)
        if not self._fs.rename(self._Path(aside), self._Path(f"{self.path}/_log/{number:012d}-{gen}")):
            raise OSError(f"could not publish {gen} in {self.path}")

    # -- reading ---------------------------------------------------------------
    def _log(self) -> list[tuple[int, str]]:
        """(number, generation) of every publication, oldest first."""
        log = self._Path(f"{self.path}/_log")
        if not self._fs.exists(log):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(log)]
        return sorted((int(n), g) for n, g in (x.split("-", 1) for x in names
                                               if not x.startswith((".", "_"))))

    def _partitions(self, gen: str) -> dict[tuple, str]:
        """Key values of a generation's partitions, and their folders."""
        pattern = f"{self.path}/gen={gen}/" + "/".join(f"{k}=*" for k in self.keys)
        out = {}
        for s in self._fs.globStatus(self._Path(pattern)) or ():
            path = s.getPath().toString()
            parts = path.split("/")[-len(self.keys):]
            out[tuple(unquote(p.split("=", 1)[1]) for p in parts)] = path
        return out

    def live(self) -> dict[tuple, str]:
        """The folder that counts for each key."""
        out: dict[tuple, str] = {}
        for _, gen in self._log():
            out.update(self._partitions(gen))
        return out

    def schema(self) -> StructType | None:
        """As last published."""
        log = self._log()
        if not log:
            return None
        number, gen = log[-1]
        text = self.spark.read.text(f"{self.path}/_log/{number:012d}-{gen}", wholetext=True).first()[0]
        return StructType.fromJson(json.loads(text))

    def read(self, **chosen) -> DataFrame | None:
        """The stored rows; ``chosen`` gives a key column's value or values, and
        only those folders are opened. None if nothing was ever published."""
        schema = self.schema()
        if schema is None:
            return None
        wanted = {k: {str(x) for x in ([v] if isinstance(v, str) or not hasattr(v, "__iter__") else v)}
                  for k, v in chosen.items() if v is not None}
        paths = sorted(path for key, path in self.live().items()
                       if all(key[self.keys.index(k)] in v for k, v in wanted.items()))
        if not paths:
            return self.spark.createDataFrame([], schema)
        got = (self.spark.read.format(self.fmt).options(**self.options).schema(schema)
               .option("basePath", self.path).load(paths))
        return got.select(*[f"`{c}`" for c in schema.names])

    # -- cleaning --------------------------------------------------------------
    def vacuum(self, hours: float = 24.0) -> int:
        """Deletes folders that no longer count: replaced partitions, and
        generations never published that are older than ``hours``. Plans made
        before a replacement should have ended by then. Returns how many."""
        live, gone = set(self.live().values()), 0
        published = [g for _, g in self._log()]
        for gen in published:
            own = self._partitions(gen)
            for path in own.values():
                if path not in live:
                    gone += bool(self._fs.delete(self._Path(path), True))
        before = (time.time() - hours * 3600) * 1000
        for s in self._fs.globStatus(self._Path(f"{self.path}/gen=*")) or ():
            gen = s.getPath().getName()[4:]
            if gen not in published and s.getModificationTime() < before:
                gone += bool(self._fs.delete(s.getPath(), True))
        return gone
