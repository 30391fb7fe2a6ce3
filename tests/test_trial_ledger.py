"""Trial ledgers: finished trials are kept, none is run twice, the best is
scored once."""

import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from barpanel.operators import features as FT
from barpanel.operators import models as ML
from barpanel.operators import search as H
from barpanel.operators.ledger import TrialLedger
from barpanel.plans.layout import PLAIN
from barpanel.sources import panel_io as IO


@pytest.fixture
def path(spark):
    return IO.scratch_path(spark, "test-ledger").removeprefix("file:")


@pytest.fixture(scope="module")
def stored(spark, daily):
    seqs = FT.prepare_panel(daily, PLAIN, window=5)["sequences"]
    p = IO.scratch_path(spark, "test-windows")
    IO.write_sequences(seqs.filter("ticker IN ('2-HIGH', '5-LOW')"), p)
    return IO.read_sequences(spark, p)


@pytest.fixture
def small(monkeypatch):
    """A space of quick trials, and a count of the fits."""
    monkeypatch.setitem(H.TREE_SPACE, "n_estimators", ("int", 1, 3))
    monkeypatch.setitem(H.TREE_SPACE, "max_depth", ("int", 1, 2))
    fits, real = [], ML.GBTModel.fit_prepared

    def fit(self, data):
        fits.append(threading.get_ident())
        return real(self, data)
    monkeypatch.setattr(ML.GBTModel, "fit_prepared", fit)
    return fits


def studies(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "study string")


def test_claims_and_commits(spark, path):
    a, b = TrialLedger(spark, path), TrialLedger(spark, path)
    assert a.claim("x/1", 0) and not b.claim("x/1", 0) and b.claim("x/1", 1)
    a.commit("x/1", 0, 0.6, 1.0, 0.2)
    assert not a.claim("x/1", 0) and not b.claim("x/1", 0)
    assert a.finished("x/1") == {("x/1", 0)} and a.studies() == ["x/1"]
    b.release("x/1", 1)
    assert a.claim("x/1", 1)
    r = a.rows().collect()
    assert [(x.study, x.trial, x.value, x.val_mae, x.state) for x in r] == [
        ("x/1", 0, 0.6, 0.2, "COMPLETE")]


def test_first_commit_of_a_trial_counts(spark, path):
    a, b = TrialLedger(spark, path), TrialLedger(spark, path)
    a.commit("s", 3, 0.5)
    b.commit("s", 3, 0.9)
    a.commit("s", 4, 0.5)
    assert [(r.trial, r.value) for r in a.rows().orderBy("trial").collect()] == [(3, 0.5), (4, 0.5)]
    assert b.best("s") == (3, 0.5) and b.best("none") is None


def test_claim_of_a_dead_searcher_is_taken_over_once(spark, path):
    dead = TrialLedger(spark, path, lease=0.2)
    assert dead.claim("s", 0)
    dead._held.clear()  # no longer renewed
    time.sleep(0.5)
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda k: TrialLedger(spark, path, lease=60.0).claim("s", 0)
                            if k else TrialLedger(spark, path, lease=0.2).claim("s", 0), [0] * 8))
    assert sum(got) == 1


def test_running_trial_keeps_its_claim(spark, path):
    a = TrialLedger(spark, path, lease=0.4)
    assert a.claim("s", 0)
    time.sleep(1.2)
    assert not TrialLedger(spark, path, lease=0.4).claim("s", 0)
    a.release("s", 0)


def test_killed_study_resumes_with_what_it_had(spark, stored, small, path, monkeypatch):
    count = ML.GBTModel.fit_prepared

    def dies(self, data):
        if len(small) == 2:
            raise KeyboardInterrupt
        return count(self, data)
    monkeypatch.setattr(ML.GBTModel, "fit_prepared", dies)
    with pytest.raises(KeyboardInterrupt):
        H.resume_models(stored, studies(spark, "2-HIGH"), 5, path, threads=1)
    kept = {r.trial: r for r in TrialLedger(spark, path).rows().collect()}
    assert len(kept) == 2 and TrialLedger(spark, path).tests().count() == 0
    monkeypatch.setattr(ML.GBTModel, "fit_prepared", count)
    small.clear()
    got = H.resume_models(stored, studies(spark, "2-HIGH"), 5, path, threads=2).collect()
    assert len(small) == 3 and len(got) == 5
    again = {r.trial: r for r in TrialLedger(spark, path).rows().collect()}
    assert all(again[k] == r for k, r in kept.items())
    best = [r for r in got if r.is_best]
    assert len(best) == 1 and best[0].test_mae is not None
    assert best[0].value == max(r.value for r in got)
    assert all(r.test_mae is None for r in got if not r.is_best)


def test_two_searchers_run_no_trial_twice(spark, stored, small, path):
    names = studies(spark, "2-HIGH", "5-LOW")
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda _: H.resume_models(stored, names, 3, path, threads=2), range(2)))
    got = H.resume_models(stored, names, 3, path).collect()  # scores what neither ended
    assert len(small) == 6 and len(got) == 6
    assert len({r.searcher for r in TrialLedger(spark, path).rows().collect()}) >= 1
    assert {r.study for r in got if r.is_best and r.test_mae is not None} == {"2-HIGH", "5-LOW"}


def test_budget_stops_inside_a_study_and_best_is_scored_once(spark, stored, small, path):
    names = studies(spark, "2-HIGH")
    part = H.resume_models(stored, names, 3, path, budget=2).collect()
    assert len(small) == 2 and len(part) == 2 and all(r.test_mae is None for r in part)
    H.resume_models(stored, names, 3, path)
    assert len(small) == 3
    before = sorted(os.listdir(f"{path}/tests/2-HIGH"))
    H.resume_models(stored, names, 3, path)
    assert len(small) == 3 and sorted(os.listdir(f"{path}/tests/2-HIGH")) == before
    # the test metrics are those of the stored model of the best trial
    best = TrialLedger(spark, path).best("2-HIGH")[0]
    m = ML.GBTModel.load(f"{path}/models/2-HIGH/{best:08d}")
    t = stored.filter("ticker = '2-HIGH' AND split = 'test'")
    want = m.evaluate(t).first()["mae"]
    got = [r for r in H.resume_models(stored, names, 3, path).collect() if r.is_best][0]
    assert got.test_mae == pytest.approx(want)


def test_trials_of_several_studies_take_turns():
    """Neighbouring studies are mixed, the longest trials first; none is lost."""
    tasks = [(f"s{k:02d}", {"trial": t, "n_estimators": 100 * (1 + (t + k) % 3), "max_depth": 4})
             for k in range(10) for t in range(3)]
    got = H.in_turn(tasks, studies=8)
    assert sorted(map(str, got)) == sorted(map(str, tasks))
    assert {s for s, _ in got[:24]} == {f"s{k:02d}" for k in range(8)}
    assert len({s for s, _ in got[:8]}) == 8
    assert [t["n_estimators"] for _, t in got[:24]] == [300] * 8 + [200] * 8 + [100] * 8


def test_failing_trial_keeps_its_error(spark, stored, path):
    ledger = TrialLedger(spark, path)
    trials = [{"trial": 0, "n_estimators": 2, "max_depth": 2},
              {"trial": 1, "n_estimators": 2, "max_depth": 99}]
    assert H.run_study(stored, "2-HIGH", trials, ledger, threads=1) == 2
    rows = {r.trial: r for r in ledger.rows().collect()}
    assert rows[0].state == "COMPLETE" and ledger.best("2-HIGH")[0] == 0
    assert rows[1].state.startswith("FAIL") and rows[1].value == 0.0


def test_trials_share_one_cache(spark, stored, path, small):
    """No trial drops the vectors of the others; nothing stays cached."""
    trials = [{"trial": k, "n_estimators": 2, "max_depth": 1 + k % 2} for k in range(4)]
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    H.run_study(stored, "2-HIGH", trials, TrialLedger(spark, path), threads=4)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
