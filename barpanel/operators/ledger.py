"""Ledger of a search's trials (H4): what is finished stays finished.

A trial is *claimed* before it is run and *committed* as one small file when it
is done, so a searcher that is pre-empted loses only the trials it was in, and
several searchers (a job array, say) share one ledger without running a trial
twice. A claim is a file that only one searcher can create; while the trial
runs its time is renewed, and a claim that has not been renewed for ``lease``
seconds belongs to a dead searcher and may be taken over. Should a trial be
committed twice all the same (a searcher that was thought dead), the first
commit counts. Rows are read with Spark; the driver lists file names.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROW = ("study string, trial bigint, value double, val_sharpe double, val_mae double, state string, "
       "searcher string, committed bigint")
TEST = "study string, trial bigint, metrics map<string,double>, searcher string, committed bigint"

_claiming = threading.Lock()  # searchers in threads of one driver


class TrialLedger:
    def __init__(self, spark: SparkSession, path: str, lease: float = 120.0,
                 searcher: str | None = None):
        self.spark, self.path, self.lease = spark, path.rstrip("/"), lease
        self.searcher = searcher or uuid.uuid4().hex[:12]
        self._Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration())
        self._held: set[tuple[str, int]] = set()
        self._beat: threading.Thread | None = None

    def _claim_path(self, study: str, trial: int):
        return self._Path(f"{self.path}/claims/{quote(study, safe='')}/{trial:08d}")

    # -- claims ------------------------------------------------------------------
    def claim(self, study: str, trial: int) -> bool:
        """Whether the trial is this searcher's to run now."""
        p = self._claim_path(study, trial)
        with _claiming:
            if (study, trial) in self.finished(study):
                return False
            if self._fs.exists(p):
                age = time.time() - self._fs.getFileStatus(p).getModificationTime() / 1000
                # of several that find it stale, one can move it away
                stale = self._Path(f"{self.path}/claims/_stale-{uuid.uuid4().hex}")
                if age <= self.lease or not self._fs.rename(p, stale):
                    return False
            self._fs.mkdirs(p.getParent())
            if not self._fs.createNewFile(p):
                return False
            self._held.add((study, trial))
        if self._beat is None:
            self._beat = threading.Thread(target=self._renew, daemon=True)
            self._beat.start()
        return True

    def _renew(self) -> None:
        while self._held:
            for study, trial in list(self._held):
                try:
                    self._fs.setTimes(self._claim_path(study, trial), int(time.time() * 1000), -1)
                except Exception:  # noqa: BLE001  taken over, or the session has ended
                    self._held.discard((study, trial))
            time.sleep(max(0.05, self.lease / 4))
        self._beat = None

    def release(self, study: str, trial: int) -> None:
        """Gives an unfinished trial back at once."""
        self._held.discard((study, trial))
        self._fs.delete(self._claim_path(study, trial), False)

    # -- commits -----------------------------------------------------------------
    def _put(self, kind: str, study: str, trial: int, row: dict) -> None:
        name = f"{quote(study, safe='')}/{trial:08d}-{self.searcher}"
        aside = self._Path(f"{self.path}/_aside/{uuid.uuid4().hex}")
        out = self._fs.create(aside, True)
        try:
            out.write(bytearray(json.dumps(
                {"study": study, "trial": trial, **row, "searcher": self.searcher,
                 "committed": time.time_ns()}).encode()))
        finally:
            out.close()
        target = self._Path(f"{self.path}/{kind}/{name}")
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(aside, target) and not self._fs.exists(target):
            raise OSError(f"could not commit {kind}/{name}")

    def commit(self, study: str, trial: int, value: float, val_sharpe=None, val_mae=None,
               state: str = "COMPLETE") -> None:
        """One row for a finished trial; the claim has served."""
        self._put("results", study, trial, dict(value=value, val_sharpe=val_sharpe,
                                                val_mae=val_mae, state=state))
        self._held.discard((study, trial))

    def commit_test(self, study: str, trial: int, metrics: dict) -> None:
        """The test metrics of a study's best trial."""
        self._put("tests", study, trial, dict(metrics=metrics))

    def _names(self, kind: str, study: str) -> set[tuple[str, int]]:
        folder = self._Path(f"{self.path}/{kind}/{quote(study, safe='')}")
        if not self._fs.exists(folder):
            return set()
        return {(study, int(s.getPath().getName().split("-")[0]))
                for s in self._fs.listStatus(folder)}

    def finished(self, study: str) -> set[tuple[str, int]]:
        return self._names("results", study)

    def tested(self, study: str) -> set[tuple[str, int]]:
        return self._names("tests", study)

    def studies(self) -> list[str]:
        folder = self._Path(f"{self.path}/results")
        if not self._fs.exists(folder):
            return []
        return sorted(unquote(s.getPath().getName()) for s in self._fs.listStatus(folder))

    def _rows(self, kind: str, schema: str) -> DataFrame:
        if not self._fs.exists(self._Path(f"{self.path}/{kind}")):
            return self.spark.createDataFrame([], schema)
        got = (self.spark.read.schema(schema).option("recursiveFileLookup", True)
               .json(f"{self.path}/{kind}"))
        first = Window.partitionBy("study", "trial").orderBy("committed", "searcher")
        return got.withColumn("_k", F.row_number().over(first)).filter("_k = 1").drop("_k")

    def rows(self) -> DataFrame:
        """The finished trials, one row each: the first commit of a trial counts."""
        return self._rows("results", ROW)

    def tests(self) -> DataFrame:
        return self._rows("tests", TEST)

    def best(self, study: str) -> tuple[int, float] | None:
        """(trial, value) of the best finished trial; the smaller trial of equals."""
        r = (self.rows().filter(F.col("study") == study)
             .orderBy(F.desc("value"), F.asc("trial")).first())
        return None if r is None else (r["trial"], r["value"])
