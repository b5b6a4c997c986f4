"""Calls to an injected client: several at a time in each task, and a journal of the answers that were paid for."""

from __future__ import annotations

import functools
import hashlib
import threading
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Client = Callable[[dict, str], str]
Answer = tuple[str | None, int, str | None]  # answer, attempts made, last error


class Pace:
    """When the calls of a task may start: at most rate in a second, and none before what a client's error asks for (its retry_after, in seconds)."""

    def __init__(self, rate: float | None) -> None:
        self._gap = 1 / rate if rate else 0.0
        self._next = 0.0
        self._lock = threading.Lock()

    def wait(self) -> None:
        with self._lock:
            now = time.monotonic()
            begin = max(now, self._next)
            self._next = begin + self._gap
        if begin > now:
            time.sleep(begin - now)

    def hold(self, seconds: float) -> None:
        with self._lock:
            self._next = max(self._next, time.monotonic() + seconds)


def call_client(client: Client, row: dict, prompt: str, attempts: int, delay: float, retry_on: tuple[type[Exception], ...], pace: Pace | None = None) -> Answer:
    """(answer, attempts made, last error). An answer is never asked for again, whatever it says.

    An error with a number retry_after holds back all calls of the pace for so many seconds, itself included.
    """
    error = None
    for n in range(1, attempts + 1):
        if pace:
            pace.wait()
        try:
            return client(row, prompt), n, None
        except retry_on as e:
            error = f"{type(e).__name__}: {e}"
            asked = getattr(e, "retry_after", None)
            if asked is not None and pace:
                pace.hold(float(asked))
            elif n < attempts and delay > 0:
                time.sleep(delay)
        except Exception as e:  # not worth a retry: the row stays, without an answer
            return None, n, f"{type(e).__name__}: {e}"
    return None, attempts, error


@dataclass
class Journal:
    """Answers in files below path (one that pyarrow.fs reaches from all executors): a folder for each bucket of keys, in it files of a few
    answers each, which appear whole or not at all. A key is the row's and the prompt's."""

    path: str
    buckets: int = 1024  # of a journal for good; a task holds a bucket's answers
    every: int = 16  # answers in a file
    seconds: float = 5.0  # or what was answered in so many seconds
    retry_failed: bool = False  # whether rows whose calls all failed are asked again

    def place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("/") else self.path.replace("file:", "file://", 1))

    def _folder(self, base: str, bucket: int) -> str:
        return f"{base}/of={self.buckets}/bucket={bucket}"

    def read(self, bucket: int) -> dict[str, Answer]:
        system, base = self.place()
        found: dict[str, Answer] = {}
        for info in system.get_file_info(fs.FileSelector(self._folder(base, bucket), allow_not_found=True)):
            if info.base_name.startswith("answers-"):
                with system.open_input_file(info.path) as f:
                    for r in pq.read_table(f).to_pylist():
                        if r["raw"] is not None or not self.retry_failed:
                            found[r["key"]] = (r["raw"], r["attempts"], r["error"])
        return found

    def add(self, bucket: int, rows: list[tuple[str, str | None, Answer]]) -> None:
        """rows: key, name, answer."""
        system, base = self.place()
        folder, name = self._folder(base, bucket), uuid.uuid4().hex
        system.create_dir(folder, recursive=True)
        table = pa.table({"key": [k for k, _, _ in rows], "name": pa.array([n for _, n, _ in rows], pa.string())} | {
            c: pa.array([a[i] for _, _, a in rows], t) for i, (c, t) in enumerate((("raw", pa.string()), ("attempts", pa.int32()), ("error", pa.string())))})
        with system.open_output_stream(f"{folder}/_{name}") as f:  # readers pass over names with _
            pq.write_table(table, f)
        system.move(f"{folder}/_{name}", f"{folder}/answers-{name}.parquet")


def call_key(name: object, prompt: str | None) -> str:
    return hashlib.sha256(f"{name}\0{prompt}".encode()).hexdigest()


class _Window:
    """Runs calls for a task: in_flight at a time, answers in the order of the rows. Each thread has its own client."""

    def __init__(self, client_factory: Callable[[], Client], in_flight: int, one: Callable[[Client, dict, str], Answer]) -> None:
        self._own = threading.local()
        self._factory, self._one = client_factory, one
        self.pool = ThreadPoolExecutor(in_flight)
        self.ahead = 8 * in_flight  # rows that may be finished or running while an earlier one is not

    def submit(self, row: dict, prompt: str, arrived: Callable[[Answer], None]) -> Future:
        """arrived gets the answer before the call counts as done."""

        def run() -> Answer:
            if not hasattr(self._own, "client"):
                self._own.client = self._factory()
            answer = self._one(self._own.client, row, prompt)
            arrived(answer)
            return answer

        return self.pool.submit(run)


def call_batch(
    rows: DataFrame, client_factory: Callable[[], Client], prompt: Column, partitions: int | None = None, attempts: int = 3, delay: float = 5.0,
    retry_on: tuple[type[Exception], ...] = (Exception,), in_flight: int = 1, rate: float | None = None, journal: Journal | None = None, key: str = "name",
) -> DataFrame:
    """rows with raw (the answer), attempts and error, in the order of each partition's rows.

    A task has up to in_flight calls at a time, each thread a client of its own, and starts at most rate of them in a second; partitions
    are the tasks. Failed calls are made again up to attempts times after delay seconds, while others go on.

    With a journal each answer is kept soon after it arrives, by key and prompt. What the journal holds is not asked for again: neither by a task that is
    repeated after a failure, nor by a second run, nor when the result is computed again. Rows of one key and prompt get one answer. Without a journal write
    the result before using it twice.
    """
    asked = rows.withColumn("__prompt", prompt)
    if journal is not None:
        tasks = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # a bucket is one task's: what a lost task has answered is read by the task that repeats it
        asked = asked.withColumn("__bucket", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(journal.buckets)).cast("int")).repartition(tasks, "__bucket").sortWithinPartitions("__bucket")
    elif partitions is not None:
        asked = asked.repartition(partitions)
    fields = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    hidden = [c for c in asked.columns if c not in rows.columns]

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace = Pace(rate)
        window = _Window(client_factory, in_flight, lambda client, row, text: call_client(client, row, text, attempts, delay, retry_on, pace))
        book = _Book(journal)
        try:
            for frame in frames:
                shown = frame.drop(columns=hidden)
                records = shown.to_dict("records")
                places = frame["__bucket"].tolist() if journal is not None else [0] * len(frame)
                answers: list[Answer] = [(None, 0, None)] * len(frame)
                waiting: deque[tuple[int, str, Future]] = deque()  # row, key, call

                def settle(most: int) -> None:
                    while len(waiting) > most:
                        book.poll()
                        i, name, future = waiting[0]
                        if not future.done():
                            wait([future], timeout=0.2, return_when=FIRST_COMPLETED)
                            continue
                        waiting.popleft()
                        answers[i] = future.result()
                        book.settled(name, answers[i])

                for i, (row, text) in enumerate(zip(records, frame["__prompt"].tolist(), strict=True)):
                    name = call_key(row[key], text) if journal is not None else ""
                    held = book.known(places[i], name)
                    if isinstance(held, tuple):
                        answers[i] = held
                        continue
                    if held is None:
                        held = window.submit(row, text, functools.partial(book.arrived, places[i], name, row.get(key)))
                        book.expect(name, held)
                    waiting.append((i, name, held))
                    settle(window.ahead)
                settle(0)
                book.flush()
                yield shown.assign(raw=[a[0] for a in answers], attempts=[a[1] for a in answers], error=[a[2] for a in answers])
        finally:
            window.pool.shutdown(wait=False, cancel_futures=True)

    return asked.mapInPandas(call, f"{fields}, raw string, attempts int, error string")


class _Book:
    """What a task reads from and adds to its journal: answers in the order in which they arrive."""

    def __init__(self, journal: Journal | None) -> None:
        self._journal = journal
        self._bucket: int | None = None
        self._known: dict[str, Future | Answer] = {}  # of the bucket: calls under way, answers
        self._new: deque[tuple[int, str, str | None, Answer]] = deque()  # not yet in the journal; calling threads add to it
        self._since = time.monotonic()

    def known(self, bucket: int, key: str) -> Future | Answer | None:
        if self._journal is None:
            return None
        if bucket != self._bucket:
            self._bucket, self._known = bucket, dict(self._journal.read(bucket))
        return self._known.get(key)

    def expect(self, key: str, future: Future) -> None:
        if self._journal is not None:
            self._known[key] = future

    def settled(self, key: str, answer: Answer) -> None:
        """An answer takes the place of its call, which is larger."""
        if key in self._known:
            self._known[key] = answer

    def arrived(self, bucket: int, key: str, name: object, answer: Answer) -> None:
        if self._journal is not None:
            self._new.append((bucket, key, None if name is None else str(name), answer))

    def poll(self) -> None:
        if self._new and self._journal is not None and (len(self._new) >= self._journal.every or time.monotonic() - self._since > self._journal.seconds):
            self.flush()

    def flush(self) -> None:
        """Keeps all answers that have arrived."""
        if self._journal is None:
            return
        ready: dict[int, list[tuple[str, str | None, Answer]]] = {}
        for _ in range(len(self._new)):
            bucket, key, name, answer = self._new.popleft()
            ready.setdefault(bucket, []).append((key, name, answer))
        for bucket, rows in ready.items():
            self._journal.add(bucket, rows)
        self._since = time.monotonic()


def read_journal(spark: SparkSession, journal: Journal) -> DataFrame:
    """key, name, raw, attempts, error of a journal, each key once: of several answers (two tasks may have asked at the same time) one that did not fail,
    the first by its text."""
    kept = spark.read.schema("key string, name string, raw string, attempts int, error string").option("recursiveFileLookup", "true").parquet(journal.path)
    return kept.groupBy("key").agg(F.min_by(F.struct("name", "raw", "attempts", "error"), F.struct(F.col("raw").isNull(), "raw", "attempts")).alias("r")).select("key", "r.*")
