"""Atomic commits, the commit log and the key index (K7, K8, K9, T4)."""

import os
import re

import pytest

from helpers import AS_OF, envelopes, record
from quayside.plans.ingest import accepted_conformed, process_events
from quayside.sinks.commit import BatchCommits, read_committed
from quayside.sinks.commitlog import COMPACT_AFTER, CommitLog, HadoopFolder
from quayside.sinks.deliver import deliver, read_ledger
from quayside.sinks.keyindex import KeyIndex
from quayside.sinks.writers import files_sink


def _batch(spark, ids):
    rows = [record(event_id=i) for i in ids]
    return accepted_conformed(process_events(envelopes(spark, rows), as_of=AS_OF), keep=("partition", "offset"))


class Memory:
    """A folder in memory that counts reads."""

    def __init__(self):
        self.files, self.opened = {}, 0

    def names(self):
        return list(self.files)

    def read(self, name):
        self.opened += 1
        return self.files[name]

    def put(self, name, text):
        if name in self.files:
            return False
        self.files[name] = text
        return True

    def delete(self, name):
        del self.files[name]


def test_lookup_opens_few_files_after_ten_thousand_entries():
    folder = Memory()
    log = CommitLog(folder)
    for i in range(10_000):
        log.append([{"batch": i % 1000, "n": i}])
    folder.opened = 0
    assert [r["n"] for r in log.records()] == list(range(10_000))
    assert folder.opened <= COMPACT_AFTER + 1 and len(folder.files) <= COMPACT_AFTER + 1


def test_two_writers_lose_nothing():
    folder = Memory()
    a, b = CommitLog(folder, 4), CommitLog(folder, 4)
    stale = folder.names
    for i in range(20):
        old = folder.names()
        b.append([{"b": i}])
        folder.names = lambda old=old: old if len(old) else []       # a lists before b wrote
        try:
            state = a._state()
        finally:
            folder.names = stale
        number = max([state[0], *state[1]]) + 1
        while f"{number:012d}.json" in folder.files or not folder.put(f"{number:012d}.json", f'{{"a": {i}}}\n'):
            number += 1
    found = CommitLog(folder, 4).records()
    assert sorted(r["b"] for r in found if "b" in r) == list(range(20))


def test_log_on_the_file_system(spark, tmp_dir):
    log = CommitLog(HadoopFolder(spark, f"{tmp_dir}/log with blank"), 3)
    assert log.records() == []
    for i in range(8):
        assert log.append([{"n": i, "text": "é\n"}]) == i
    assert [r["n"] for r in log.records()] == list(range(8)) and log.records()[0]["text"] == "é\n"
    assert len([f for f in os.listdir(f"{tmp_dir}/log with blank") if not f.startswith(".")]) <= 4
    assert not log.folder.put(sorted(log.folder.names())[-1], "x")


@pytest.mark.parametrize("crash", ["staged", "committed", "half moved", "moved"])
def test_a_crash_at_any_point_leaves_one_copy(spark, tmp_dir, monkeypatch, crash):
    path, sink = f"{tmp_dir}/s", files_sink("s", f"{tmp_dir}/s")
    batch = _batch(spark, [f"e{i}" for i in range(20)])

    def broken(self, *args):
        raise RuntimeError("crash")

    if crash == "staged":
        monkeypatch.setattr(CommitLog, "append", broken)
    elif crash == "committed":
        monkeypatch.setattr(BatchCommits, "publish", broken)
    elif crash == "half moved":
        def some(self, entry):
            first = entry["files"][0]
            os.makedirs(os.path.dirname(f"{path}/{first}"), exist_ok=True)
            os.rename(f"{path}/{entry['stage']}/{first}", f"{path}/{first}")
            raise RuntimeError("crash")
        monkeypatch.setattr(BatchCommits, "publish", some)
    if crash == "moved":
        deliver(batch, 0, [sink], None, "run")                    # the ledger row is lost
    else:
        with pytest.raises(RuntimeError):
            deliver(batch, 0, [sink], None, "run", on_error="fail")
    monkeypatch.undo()
    if crash in ("committed", "half moved"):
        assert read_committed(spark, path).count() == 20          # readers of commits finish the moves
    row = deliver(batch, 0, [sink], f"{tmp_dir}/ledger", "run").first()
    assert (row.status, row.rows) == ("ok", 20)
    assert spark.read.parquet(path).count() == read_committed(spark, path).count() == 20
    deliver(batch, 1, [sink], f"{tmp_dir}/ledger", "run")
    deliver(batch, 0, [sink], f"{tmp_dir}/ledger", "other run")
    assert spark.read.parquet(path).count() == 60
    assert [r.status for r in read_ledger(spark, f"{tmp_dir}/ledger").collect()] == ["ok"] * 3


def test_a_stage_without_a_commit_is_never_read(spark, tmp_dir):
    path = f"{tmp_dir}/s"
    commits = BatchCommits(spark, path)
    with pytest.raises(RuntimeError):
        def write(folder):
            spark.range(5).write.parquet(folder)
            raise RuntimeError("lost")
        commits.commit("r", 0, write)
    assert read_committed(spark, path) is None and commits.recover() == 0


def _files(df):
    return sorted(re.sub(".*/(bucket=.*?)/.*", r"\1", f) for f in df.inputFiles())


def test_index_opens_only_buckets_that_may_hold_a_key(spark, tmp_dir):
    index = KeyIndex(f"{tmp_dir}/k", buckets=64)
    old = spark.range(20_000).selectExpr("concat('old', id) AS event_id")
    index.rebuild(spark, old)
    known = spark.range(3).selectExpr("concat('old', id) AS event_id")
    new = spark.range(200).selectExpr("concat('new', id) AS event_id")
    assert 1 <= len(set(_files(index.held(known)))) <= 3                 # grows with the batch, not with the sink
    assert len(set(_files(index.held(new)))) <= 10                       # new keys open next to nothing
    assert len(set(_files(index.held(old)))) == 64
    both = known.union(new).union(spark.createDataFrame([(None,)], "event_id string"))
    assert sorted(str(r[0]) for r in index.drop_held(both).collect()) == sorted([f"new{i}" for i in range(200)] + ["None"])
    index.add(new)
    index.add(new)
    assert index.drop_held(both).count() == 1
    index.rebuild(spark, old)
    assert index.drop_held(both).count() == 201


def test_keys_stay_unique_over_crashes(spark, tmp_dir, monkeypatch):
    path, sink = f"{tmp_dir}/s", files_sink("s", f"{tmp_dir}/s")
    a, b = _batch(spark, [f"e{i}" for i in range(20)]), _batch(spark, [f"e{i}" for i in range(10, 30)])
    monkeypatch.setattr(KeyIndex, "add", lambda self, rows: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        deliver(a, 0, [sink], f"{tmp_dir}/l", "r", on_error="fail", dedup=True, key_scope="all")
    monkeypatch.undo()
    deliver(a, 0, [sink], f"{tmp_dir}/l", "r", dedup=True, key_scope="all")      # the replay brings the keys
    row = deliver(b, 1, [sink], f"{tmp_dir}/l", "r", dedup=True, key_scope="all").first()
    assert row.rows == 10 and spark.read.parquet(path).count() == 30
