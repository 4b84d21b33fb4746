"""A durable journal of calls to services that cost money or change something: OCR, models, geocoding, uploads.

A request is known by its content. What is to be asked is written down first; each task then writes its answers into the journal's
folder while it calls, in files that appear whole, a few calls each. So answers don't wait for a task to end: where an executor is
lost, the task's next attempt reads what the one before wrote, and where a whole run is lost, the next run asks only what has no
answer yet. What may be asked twice is what was under way when a process died: `flush_every` calls of each task at most. Attempts
of one request, and answers given twice, are resolved by rule: the earliest good answer counts.

    root/requests/run=R/...         what run R was going to ask (Parquet)
    root/answers/run=R/part-P-A-N   answers of attempt A of partition P, JSON lines
    root/packed/run=R/...           the same as Parquet, after pack()
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage

ANSWER = "call_key string, stage string, at double, place long, attempt int, ok boolean, answer string, error string"


def call_key(stage: str, columns: list[str]) -> Column:
    """A request's key: a digest of the stage and of what is asked; nulls and empty texts differ."""
    body = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return F.sha2(F.concat(F.lit(stage + "\n"), body).cast("binary"), 256)


def resolve(attempts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row for each request of recorded attempts (keys, at, place, ok, answer, error): whether it was answered, the earliest good
    answer, the number of attempts, and the last error where there is no good one. Partial aggregation, so a request with many attempts is
    no hot group."""
    good = F.coalesce("ok", F.lit(False))
    order = F.struct("at", "place")
    found = attempts.groupBy(*(keys or ["call_key"])).agg(
        F.max(good).alias("ok"), F.min_by("answer", F.when(good, order)).alias("answer"), F.count(F.lit(1)).cast("int").alias("attempts"), F.max_by("error", F.when(~good, order)).alias("_error")
    )
    return found.withColumn("error", F.when(~F.col("ok"), F.col("_error"))).drop("_error")


def unanswered(requests: DataFrame, attempts: DataFrame, keys: list[str] | None = None, most: int = 3) -> DataFrame:
    """Requests that have no good answer and fewer than `most` attempts, each once."""
    keys = keys or ["call_key"]
    done = resolve(attempts, keys).where(F.col("ok") | (F.col("attempts") >= most)).select(*keys)
    return requests.dropDuplicates(keys).join(done, keys, "left_anti")


class Journal:
    """The journal in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def attempts(self) -> DataFrame:
        """Every recorded attempt."""
        packed = [n for n in storage.children(f"{self.root}/packed") if storage.exists(f"{self.root}/packed/{n}/_SUCCESS")]
        loose = [n for n in storage.children(f"{self.root}/answers") if n not in packed]
        out = self.spark.createDataFrame([], ANSWER)
        if packed:
            out = out.unionByName(self.spark.read.schema(ANSWER).parquet(*[f"{self.root}/packed/{n}" for n in packed]))
        if loose:
            rows = self.spark.read.schema(ANSWER).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true")
            out = out.unionByName(rows.option("pathGlobFilter", "part-*").json([f"{self.root}/answers/{n}" for n in loose]))
        return out

    def pack(self) -> None:
        """Answers of ended runs as Parquet, in place of their many small files. No run may be under way."""
        for name in storage.children(f"{self.root}/answers"):
            target = f"{self.root}/packed/{name}"
            if not storage.exists(f"{target}/_SUCCESS"):
                rows = self.spark.read.schema(ANSWER).option("mode", "DROPMALFORMED").option("pathGlobFilter", "part-*").json(f"{self.root}/answers/{name}")
                rows.write.mode("overwrite").parquet(target)
            fs, path = storage.store(f"{self.root}/answers/{name}")
            fs.delete_dir(path)

    def call(
        self, requests: DataFrame, provider: Callable[[dict], dict], *, stage: str, columns: list[str], schema: str, attempts: int = 3, wait_s: float = 1.0, concurrency: int = 4, flush_every: int = 8,
        tasks: int | None = None,
    ) -> DataFrame:
        """requests with the columns of schema, ok, attempts and error. `columns` say what is asked; equal ones are asked once.

        provider gets them as a dict and returns those of schema, or raises; then it is asked again, `attempts` times in all, those of
        runs before included.
        """
        keyed = requests.withColumn("call_key", call_key(stage, columns))
        run = uuid.uuid4().hex
        todo = unanswered(keyed.select("call_key", *columns), self.attempts().where(F.col("stage") == stage), most=attempts)
        asked = f"{self.root}/requests/run={run}"
        todo.withColumn("stage", F.lit(stage)).write.parquet(asked)
        todo = self.spark.read.parquet(asked)
        if not todo.isEmpty():
            had = self.attempts().where(F.col("stage") == stage).groupBy("call_key").agg(F.max("attempt").alias("tried"))
            todo = todo.join(had, "call_key", "left").repartition(tasks or int(self.spark.conf.get("spark.sql.shuffle.partitions")), "call_key")
            write = _calls(f"{self.root}/answers/run={run}", provider, stage, columns, attempts, wait_s, concurrency, flush_every)
            todo.select("call_key", "tried", *columns).mapInPandas(write, "calls long").write.format("noop").mode("overwrite").save()
        found = resolve(self.attempts().where(F.col("stage") == stage))
        fields = found.select("call_key", F.from_json("answer", schema).alias("_a"), "ok", "attempts", "error")
        names = [c.split()[0] for c in schema.split(", ")]
        joined = keyed.join(fields, "call_key", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
        return joined.select(*requests.columns, *[F.col(f"_a.{n}").alias(n) for n in names], "ok", "attempts", "error")


def _calls(folder: str, provider, stage: str, columns: list[str], most: int, wait_s: float, concurrency: int, flush_every: int):
    """A task's calls; what an earlier attempt of the same partition has answered isn't asked again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        part, number = context.partitionId(), context.attemptNumber()
        fs, path = storage.store(folder)
        fs.create_dir(path, recursive=True)
        before: dict[str, int] = {}
        for name in storage.children(folder):
            if name.startswith(f"part-{part:05d}-"):
                with fs.open_input_stream(f"{path}/{name}", compression=None) as f:
                    for row in map(json.loads, f.read().decode().splitlines()):
                        before[row["call_key"]] = most if row["ok"] else max(before.get(row["call_key"], 0), row["attempt"])
        place, calls = 0, 0

        def ask(row: dict) -> list[dict]:
            asked, out = {c: row[c] for c in columns}, []
            tried = 0 if pd.isna(row["tried"]) else int(row["tried"])
            for k in range(max(tried, before.get(row["call_key"], 0)) + 1, most + 1):
                if out:
                    time.sleep(wait_s)
                try:
                    found, error = json.dumps(provider(asked)), None
                except Exception as e:  # a failed call is a row, not a failed job
                    found, error = None, f"{type(e).__name__}: {e}"
                out.append({"call_key": row["call_key"], "stage": stage, "at": time.time(), "attempt": k, "ok": error is None, "answer": found, "error": error})
                if error is None:
                    break
            return out

        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                rows = iter(batch.to_dict("records"))
                while window := list(islice(rows, max(concurrency, flush_every))):
                    lines = []
                    for row in [r for rs in pool.map(ask, window) for r in rs]:
                        lines.append(json.dumps(row | {"place": place}))
                        place, calls = place + 1, calls + 1
                    if lines:
                        storage.put(fs, f"{path}/part-{part:05d}-{number}-{place:09d}", ("\n".join(lines) + "\n").encode())
        yield pd.DataFrame({"calls": [calls]})

    return run


def read_through(pages: DataFrame, cache: DataFrame, ask: Callable[[DataFrame], DataFrame], *, use_cache: bool = True) -> tuple[DataFrame, DataFrame]:
    """(stem, text, ok, error) of all pages, and the new texts to be written to the cache. cache: stem, text; ask: pages -> stem, text, ok, error."""
    known = cache.select("stem", "text").dropDuplicates(["stem"])
    missing = pages.join(known.select("stem"), "stem", "left_anti") if use_cache else pages
    found = storage.written(ask(missing).select("stem", "text", "ok", "error"), "read-through")
    new = found.where("ok")
    if not use_cache:
        return found, new.select("stem", "text")
    old = pages.select("stem").join(known, "stem").withColumns({"ok": F.lit(True), "error": F.lit(None).cast("string")})
    return old.unionByName(found), new.select("stem", "text")
