"""Calls in flight, pacing, and the journal of answers."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from tagflow.operators import tagging as T
from tagflow.operators.calls import Journal, Pace, call_batch, call_client, read_journal

TOGETHER = 3
GATE = threading.Barrier(TOGETHER)


class Gated:
    """Answers only while TOGETHER calls are in flight."""

    def __call__(self, row, prompt):
        GATE.wait(timeout=20)
        return f"{prompt} {row['name']}"


class Uneven:
    """The first row takes long, every third fails for good, the others answer at once."""

    def __call__(self, row, prompt):
        n = int(row["name"])
        if n == 0:
            time.sleep(1.0)
        if n % 3 == 1:
            raise ValueError("no")
        return row["name"]


def names(spark, n, parts=1):
    return spark.range(n).select(F.col("id").cast("string").alias("name"), "id").coalesce(parts)


def test_calls_of_a_task_overlap_and_keep_their_order(spark):
    out = T.tag_batch(names(spark, 9), Gated, "p", attempts=1, in_flight=TOGETHER).collect()
    assert [(r.name, r.raw, r.attempts, r.error) for r in out] == [(str(i), f"p {i}", 1, None) for i in range(9)]
    with pytest.raises(threading.BrokenBarrierError):
        threading.Barrier(2).wait(timeout=0.01)


def test_a_failure_does_not_hold_up_others(spark):
    began = time.time()
    out = T.tag_batch(names(spark, 60), Uneven, "p", attempts=2, delay=0.3, in_flight=10).collect()
    assert time.time() - began < 15  # one after another: 20 failures of 0.3 s and more
    assert [(r.name, r.raw, r.attempts) for r in out] == [(str(i), None if i % 3 == 1 else str(i), 2 if i % 3 == 1 else 1) for i in range(60)]


class Busy(Exception):
    retry_after = 0.4


def test_pace_obeys_rate_and_retry_after():
    pace = Pace(50)
    began = time.monotonic()
    for _ in range(11):
        pace.wait()
    assert time.monotonic() - began > 0.19
    tries = []

    def client(row, prompt):
        tries.append(time.monotonic())
        if len(tries) == 1:
            raise Busy
        return "x"

    shared = Pace(None)
    assert call_client(client, {}, "", 3, 5.0, (Exception,), shared) == ("x", 2, None)
    assert 0.35 < tries[1] - tries[0] < 3
    # another thread's call waits as well
    shared.hold(0.3)
    began = time.monotonic()
    shared.wait()
    assert time.monotonic() - began > 0.25


class Logged:
    """Writes each call down; dies with its process after some, where a file says so."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, row, prompt):
        with open(f"{self.folder}/calls", "a") as f:
            f.write(row["name"] + "\n")
        with open(f"{self.folder}/calls") as f:
            made = len(f.readlines())
        if os.path.exists(f"{self.folder}/die") and made > 30:
            os._exit(1)
        if row["name"] == "7":
            raise ValueError("never")
        return "answer " + row["name"]


def calls_made(folder):
    with open(f"{folder}/calls") as f:
        return f.read().split()


def test_a_killed_task_repeats_no_kept_call(spark, tmp_path):
    folder = str(tmp_path)
    journal = Journal(f"{folder}/journal", buckets=2, every=4)
    rows = names(spark, 80).unionByName(names(spark, 5))
    ask = lambda j=journal: call_batch(rows, lambda: Logged(folder), F.lit("p"), partitions=1, attempts=1, delay=0.0, journal=j)
    (tmp_path / "die").touch()
    with pytest.raises(Exception, match="(?i)worker|exit|eof|crash"):
        ask().collect()
    kept = {r.name for r in read_journal(spark, journal).collect()}
    assert len(kept) >= 20
    (tmp_path / "die").unlink()
    out = ask().collect()
    made = calls_made(folder)
    assert all(made.count(n) == 1 for n in kept) and max(made.count(n) for n in made) <= 2 and set(made) == {str(i) for i in range(80)}
    assert sorted((r.name, r.raw) for r in out) == sorted((r.name, None if r.name == "7" else f"answer {r.name}") for r in rows.collect())
    # computing the result again, or a second run, calls nobody
    assert ask().count() == 85 and calls_made(folder) == made
    held = read_journal(spark, journal).collect()
    assert sorted(r.name for r in held) == sorted({r.name for r in rows.collect()})
    # but for failed rows, if that is wanted, and for another prompt
    ask(Journal(journal.path, buckets=2, retry_failed=True)).collect()
    assert calls_made(folder)[len(made) :] == ["7"]
    other = call_batch(names(spark, 3), lambda: Logged(folder), F.lit("q"), attempts=1, journal=journal).collect()
    assert len(other) == 3 and len(calls_made(folder)) == len(made) + 4


def test_a_journal_of_no_rows_and_of_null_names(spark, tmp_path):
    journal = Journal(str(tmp_path / "j"), buckets=2)
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "name string, n int")
    out = T.tag_batch(rows, lambda: lambda row, prompt: "x", "p", journal=journal).collect()
    assert len(out) == 3 and {r.raw for r in out} == {"x"}
    assert T.tag_batch(rows.limit(0), Gated, "p", journal=journal).collect() == []


def test_a_book_looks_at_no_call_again(tmp_path, monkeypatch):
    """A row's cost does not grow with the answers that wait for the journal: only those that arrived are looked at, once."""
    import tagflow.operators.calls as K

    asked = []
    done = K.Future.done
    monkeypatch.setattr(K.Future, "done", lambda self: asked.append(1) or done(self))
    journal = Journal(str(tmp_path), buckets=1, every=1000, seconds=60.0)
    book, window = K._Book(journal), K._Window(lambda: None, 2, lambda client, row, text: (text, 1, None))
    for i in range(400):
        assert book.known(0, str(i)) is None
        call = window.submit({}, str(i), lambda answer, i=i: book.arrived(0, str(i), i, answer))
        book.expect(str(i), call)
        assert book.known(0, str(i)) is call
        book.settled(str(i), call.result())
        book.poll()
        assert book.known(0, str(i)) == (str(i), 1, None)
    assert not asked and journal.read(0) == {}
    book.flush()
    book.flush()
    window.pool.shutdown()
    assert journal.read(0) == {str(i): (str(i), 1, None) for i in range(400)}
