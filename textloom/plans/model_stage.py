"""Model calls as a plan: distinct prompts, a cache, calls in Arrow batches, answers joined back."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.plans.lineage import cut

ANSWERS = "prompt_id string, response string, error string, attempts int"


class OutputTruncated(Exception):
    """Raised by a backend whose answer was cut off; another try would be cut off too."""


def offline(prompt: str) -> str:
    """A deterministic backend that proves the plumbing, not a model's quality."""
    return ("YES", "NO", "UNSURE")[hashlib.sha256(prompt.encode()).digest()[0] % 3]


def with_prompt_id(rows: DataFrame, model: str) -> DataFrame:
    return rows.withColumn("prompt_id", F.sha2(F.concat_ws("\u001f", F.lit(model), "prompt"), 256))


class Retryable(Exception):
    """Raised by a backend for a failure that may pass, such as a rate limit or a server's own error."""


#: Failures that are tried again; all others end a call at once.
RETRIED = (ConnectionError, TimeoutError, Retryable)


def speaks_http(model: str) -> bool:
    """Whether a model's name stands for a service: the prefix `api:`, or a name with gpt in it."""
    return model.startswith("api:") or "gpt" in model


def wait_of(prompt_id: str, attempt: int, unit: float) -> float:
    """Seconds before the next try: doubled each time, and up to a quarter more by the prompt, so that tries spread."""
    return unit * (2 ** (attempt - 1) + int(hashlib.sha256(f"{prompt_id}{attempt}".encode()).hexdigest()[:4], 16) / 0x3FFFC)


def call(prompts: DataFrame, backend: Callable[[str], str], tries: int = 3, unit: float = 0.0, concurrency: int = 8, timeout: float | None = None, retried: tuple[type[Exception], ...] = RETRIED) -> DataFrame:
    """Answers of prompts (prompt_id, prompt): response, error, attempts. A failing call is a row with its error.

    At most `concurrency` calls run at once in a task. A call that takes longer than timeout seconds counts as a
    TimeoutError and is tried again. unit: seconds that the wait before another try is made of.
    """
    ask = asker(backend, tries, unit, timeout, retried)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                yield pd.DataFrame(list(pool.map(ask, batch["prompt_id"], batch["prompt"])), columns=["prompt_id", "response", "error", "attempts"])

    return prompts.mapInPandas(run, ANSWERS)


def asker(backend: Callable, tries: int = 3, unit: float = 0.0, timeout: float | None = None, retried: tuple[type[Exception], ...] = RETRIED) -> Callable[[str, object], tuple]:
    """A function of a key and a prompt: (key, response, error, attempts)."""

    def ask(key: str, prompt: object) -> tuple:
        for attempt in range(1, tries + 1):
            try:
                return key, _timed(backend, prompt, timeout), None, attempt
            except Exception as e:  # kept as data: one row must not end the run
                if attempt == tries or not isinstance(e, retried):
                    return key, None, type(e).__name__, attempt
            if unit:
                time.sleep(wait_of(key, attempt, unit))
        return key, None, "no tries", 0

    return ask


def at_once(pool: ThreadPoolExecutor, ask: Callable, jobs: list[tuple], concurrency: int) -> list[tuple]:
    """Answers of jobs (key, prompt) in their order, a share of them to each thread."""
    shares = pool.map(lambda k: [ask(*job) for job in jobs[k::concurrency]], range(min(concurrency, len(jobs))))
    out: list = [None] * len(jobs)
    for k, share in enumerate(shares):
        out[k::concurrency] = share
    return out


#: Prompts of whole texts, or documents with their triples, that a task holds at once.
HELD = 256


def in_place(rows: DataFrame, backend: Callable[[str], str], concurrency: int = 8, **options) -> DataFrame:
    """rows (prompt, ...) with response and error instead of prompt, asked where they lie; a null prompt isn't asked."""
    schema = T.StructType([f for f in rows.schema if f.name != "prompt"]).add("response", "string").add("error", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = asker(backend, **options)
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in (whole.slice(k, HELD) for whole in batches for k in range(0, whole.num_rows, HELD)):
                prompts = batch.column("prompt").to_pylist()
                told = dict(zip((i for i, p in enumerate(prompts) if p is not None), at_once(pool, ask, [(p, p) for p in prompts if p is not None], concurrency)))
                columns = {name: batch.column(name) for name in batch.schema.names if name != "prompt"}
                columns |= {name: pa.array([told[i][k] if i in told else None for i in range(len(prompts))], pa.string()) for k, name in ((1, "response"), (2, "error"))}
                yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(run, schema)


def _timed(backend: Callable[[str], str], prompt: str, timeout: float | None) -> str:
    if timeout is None:
        return backend(prompt)
    alone = ThreadPoolExecutor(1)
    try:
        return alone.submit(backend, prompt).result(timeout)
    finally:
        alone.shutdown(wait=False, cancel_futures=True)


def asked(rows: DataFrame, task: str, backend: Callable[[str], str], *fields: Column, unlike: bool = False, where: Column | None = None, **options) -> DataFrame:
    """rows with response and error; the prompt is a JSON object of the task's name and the fields. Equal prompts are called once.

    unlike: no two rows have equal prompts, so they are asked where they lie. where: rows that are asked at all.
    """
    prompt = F.to_json(F.struct(F.lit(task).alias("task"), *fields))
    rows = rows.withColumn("prompt", prompt if where is None else F.when(where, prompt))
    if unlike:
        return in_place(rows, backend, **options)
    keyed = with_prompt_id(rows, task)
    answers = cut(call(keyed.where("prompt is not null").select("prompt_id", "prompt").distinct(), backend, **options))
    return keyed.join(answers.select("prompt_id", "response", "error"), "prompt_id", "left").drop("prompt_id", "prompt")


def answered(rows: DataFrame, model: str, backend: Callable[[str], str], cache_path: str) -> DataFrame:
    """rows (with prompt) and their responses; only prompts that the cache lacks are called, each once."""
    spark = rows.sparkSession
    keyed = with_prompt_id(rows, model)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(cache_path)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    wanted = keyed.select("prompt_id", "prompt").distinct()
    if there:
        wanted = wanted.join(spark.read.schema(ANSWERS).parquet(cache_path).select("prompt_id"), "prompt_id", "left_anti")
    call(wanted, backend).write.mode("append").parquet(cache_path)
    return keyed.join(spark.read.schema(ANSWERS).parquet(cache_path), "prompt_id", "left")
