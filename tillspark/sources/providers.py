"""External services as table-in, table-out stages: OCR, language models, geocoding, uploads.

No service is called from here by itself: a stage takes a provider, a function from one request to one response, and runs it over
partitions with an error column instead of failures. Fixture providers answer from a table, for tests and offline runs. Results
of a stage are to be written before they are used, so that a task that runs again does not call twice for what is there.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import text as T


def call_provider(requests: DataFrame, provider: Callable[[dict], dict], schema: str, *, key: str, concurrency: int = 4, attempts: int = 1, wait_s: float = 1.0) -> DataFrame:
    """Key, the columns of schema, ok, attempts, error, per request. At most `concurrency` calls at a time in a task."""
    names = [c.split()[0] for c in schema.split(", ")]

    def one(row: dict) -> dict:
        error = None
        for k in range(1, attempts + 1):
            try:
                found = provider(row)
                return {key: row[key]} | {c: found.get(c) for c in names} | {"ok": True, "attempts": k, "error": None}
            except Exception as e:  # a failed call is a row, not a failed job
                error = f"{type(e).__name__}: {e}"
                if k < attempts:
                    time.sleep(wait_s)
        return {key: row[key]} | dict.fromkeys(names) | {"ok": False, "attempts": attempts, "error": error}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            for b in batches:
                yield pd.DataFrame(list(pool.map(one, b.to_dict("records"))), columns=[key, *names, "ok", "attempts", "error"])

    kind = requests.schema[key].dataType.simpleString()
    return requests.mapInPandas(run, f"{key} {kind}, {schema}, ok boolean, attempts int, error string")


def answer_from(requests: DataFrame, answers: DataFrame, *, on: list[str]) -> DataFrame:
    """A fixture provider: a lookup join; requests without an answer fail with a reason."""
    found = requests.join(answers.withColumn("ok", F.lit(True)), on, "left")
    return found.withColumn("error", F.when(F.col("ok").isNull(), "no answer recorded")).withColumn("ok", F.coalesce("ok", F.lit(False)))


def geocode_queries(receipts: DataFrame) -> DataFrame:
    """Receipts (receipt_id, address, store, ocr) with `query`, the cleaned address after the store's first word.

    An address of under 12 characters gives way to the one in the text.
    """
    given = F.coalesce("address", F.lit(""))
    address = F.when(F.length(given) < 12, T.address_from_text(F.col("ocr"), F.col("store"))).otherwise(given)
    asked = T.strip(F.concat_ws(" ", T.first_word(F.coalesce("store", F.lit(""))), T.address_for_geocoder(address)))
    return receipts.withColumn("query", asked)


def geocode(receipts: DataFrame, places: DataFrame) -> DataFrame:
    """Coordinates by query; each distinct one is looked up once. places: query, latitude, longitude."""
    rows = geocode_queries(receipts)
    distinct = answer_from(rows.select("query").distinct(), places, on=["query"])
    return rows.join(distinct.select("query", "latitude", "longitude"), "query", "left")


def lacks_price(price: Column) -> Column:
    bare = T.strip(F.coalesce(price, F.lit("")))
    return (bare == "") | (F.lower(bare) == "null")


def repair_requests(items: DataFrame, texts: DataFrame) -> DataFrame:
    """receipt_id, item_idx, prompt of the items without a price: the lines around the name (T17) and what is asked. texts: receipt_id, ocr."""
    open_ = items.where(lacks_price(F.col("price"))).join(texts.select("receipt_id", "ocr"), "receipt_id")
    asked = F.concat(F.lit('The price of "'), F.col("name"), F.lit('" in this part of a receipt, as a number alone:\n'), T.line_context(F.col("ocr"), F.col("name")))
    return open_.select("receipt_id", "item_idx", asked.alias("prompt"))


def answer_cents(answer: Column) -> Column:
    """The first number of an answer, in cents."""
    return T.price_cents(F.regexp_extract(F.coalesce(answer, F.lit("")), r"\d+\.?\d*", 0))


def without_number(items: DataFrame, answers: DataFrame) -> DataFrame:
    """Items of which no answer (receipt_id, item_idx, answer) says a number."""
    return items.join(answers.where(answer_cents(F.col("answer")).isNotNull()), ["receipt_id", "item_idx"], "left_anti")


def repair_prices(items: DataFrame, answers: DataFrame, escalated: DataFrame | None = None) -> DataFrame:
    """Items without a price take the first number of the model's answer, else of the stronger model's; those still without go.

    answers, escalated: receipt_id, item_idx, answer.
    """
    keys = ["receipt_id", "item_idx"]
    found, cents = items, []
    for k, given in enumerate(g for g in (answers, escalated) if g is not None):
        found = found.join(given.select(*keys, F.col("answer").alias(f"_a{k}")), keys, "left")
        cents.append(answer_cents(F.col(f"_a{k}")))
    first = F.coalesce(*cents)
    price = F.when(~lacks_price(F.col("price")), F.col("price")).when(first.isNotNull(), T.format_cents(first, F.col("currency")))
    return found.withColumn("price", price).where("price is not null").select(*items.columns)


def normalised(answers: DataFrame, provider: Column, model: Column, prices: DataFrame) -> DataFrame:
    """A service's reply (`reply`, JSON) as raw, input_tokens, output_tokens, generation_id, cost_usd and cost_source.

    Replies hold choices with a message's content, and usage with both counts. A reply without content gives an empty text and no
    tokens; an unknown provider an error. Costs come from the reply, else from prices (provider, model, rate_in, rate_out a million).
    """
    at = lambda path: F.get_json_object("reply", path)
    raw = at("$.choices[0].message.content")
    count = lambda c: F.when(raw.isNull(), F.lit(0)).otherwise(F.coalesce(at(f"$.usage.{c}").try_cast("long"), F.lit(0)))
    rows = answers.withColumns({"_provider": provider, "_model": model}).withColumns({
        "raw": F.coalesce(raw, F.lit("")), "input_tokens": count("prompt_tokens"), "output_tokens": count("completion_tokens"),
        "generation_id": F.when(F.col("_provider") == X.WITH_GENERATION_ID, at("$.id")), "_cost": at("$.usage.cost").try_cast("double"),
    })
    rates = prices.select(F.col("provider").alias("_provider"), F.col("model").alias("_model"), "rate_in", "rate_out")
    priced = rows.join(rates, ["_provider", "_model"], "left")
    estimate = F.coalesce(F.col("input_tokens") / 1e6 * F.col("rate_in") + F.col("output_tokens") / 1e6 * F.col("rate_out"), F.lit(0.0))
    known = F.col("_provider").isin(*X.PROVIDERS)
    priced = priced.withColumns({"cost_usd": F.coalesce("_cost", estimate), "cost_source": F.when(F.col("_cost").isNull(), "estimate").otherwise("api")})
    said = F.when(~known, F.concat(F.lit("Unknown provider: "), F.coalesce("_provider", F.lit("none"))))
    return priced.withColumn("error", said).drop("_provider", "_model", "_cost", "rate_in", "rate_out")
