"""From OCR texts to flat items: the steps between the services, and the chain of them all with its error channel."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import channel, storage
from .functions import fixed as X
from .functions import text as T
from .operators import chunks, items
from .schemas import RECEIPT
from .sources import providers
from .sources.journal import Journal


def prepare(texts: DataFrame) -> DataFrame:
    """receipt_id, ocr: spaced decimals, dangling prices and noise lines dealt with."""
    return texts.withColumn("ocr", T.drop_noise_lines(T.join_price_lines(T.join_spaced_decimals(F.col("ocr")))))


def requests(prepared: DataFrame) -> DataFrame:
    """receipt_id, chunk_idx, text: what a model is asked."""
    return chunks.split(prepared)


def suspects(prepared: DataFrame, answers: DataFrame) -> DataFrame:
    """receipt_id of receipts none of whose first items is in the text."""
    parsed = answers.withColumn("_r", F.from_json(T.model_json(F.col("raw")), RECEIPT))
    chunk = F.struct("chunk_idx", F.coalesce("_r.items.productName", F.array().cast("array<string>")).alias("names"))
    names = parsed.groupBy("receipt_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(chunk)), lambda s: s["names"])).alias("names"))
    return names.join(prepared.select("receipt_id", "ocr"), "receipt_id").where(T.is_hallucinated(F.col("names"), F.col("ocr"))).select("receipt_id")


def without_hallucinations(prepared: DataFrame, answers: DataFrame, again: DataFrame) -> DataFrame:
    """Answers (receipt_id, chunk_idx, raw), with those of another model in place of a receipt's whose items aren't in its text.

    again: the other model's answers for such receipts, all their chunks; where none of them parses, the first answers stay.
    """
    suspect = suspects(prepared, answers)
    parses = F.get_json_object(T.model_json(F.col("raw")), "$").isNotNull()
    better = again.where(parses).join(suspect, "receipt_id", "left_semi")
    kept = answers.join(better.select("receipt_id").distinct(), "receipt_id", "left_anti")
    return kept.unionByName(better.select(*answers.columns))


def admit(files: DataFrame, texts: DataFrame, answers: DataFrame) -> DataFrame:
    """A row for each file of a batch with its text and its chunks' answers, and the error of the first stage that failed it.

    files: receipt_id, file; texts: receipt_id, ocr and, where a service read them, ok and error; answers: receipt_id, chunk_idx, raw,
    ok, error. A receipt fails as a whole: without text, where a model's call failed, where an answer holds no JSON.
    """
    none, no_error = F.lit(True), F.lit(None).cast("string")
    have = lambda rows, c, other: F.col(c) if c in rows.columns else other
    read = texts.select("receipt_id", "ocr", have(texts, "ok", none).alias("_read"), have(texts, "error", no_error).alias("_why"))
    chunk = F.struct("chunk_idx", "raw", have(answers, "ok", none).alias("ok"), have(answers, "error", no_error).alias("error"))
    said = answers.groupBy("receipt_id").agg(F.array_sort(F.collect_list(chunk)).alias("answers"))
    rows = channel.opened(files.join(read, "receipt_id", "left").join(said, "receipt_id", "left"))
    rows = channel.failing(rows, "read", ~F.coalesce("_read", F.lit(False)), F.coalesce("_why", F.lit("no text was read")))
    rows = channel.failing(rows, "read", T.strip(F.coalesce("ocr", F.lit(""))) == "", "the text is empty")
    lost = F.filter("answers", lambda a: ~a["ok"])
    rows = channel.failing(rows, "model", F.col("answers").isNull(), "the model gave no answer")
    rows = channel.failing(rows, "model", F.size(lost) > 0, F.coalesce(F.get(lost, F.lit(0))["error"], F.lit("the model's call failed")))
    broken = F.exists("answers", lambda a: F.get_json_object(T.model_json(a["raw"]), "$").isNull())
    return channel.failing(rows, "answer", broken, "the model's answer holds no JSON").drop("_read", "_why")


def results(files: DataFrame, quarantine: DataFrame, uploads: DataFrame | None = None) -> DataFrame:
    """File, success, message and registry (ids of what was uploaded) of each file of a batch.

    quarantine: receipt_id, error (stage, message); uploads: receipt_id, ids, error (null where all was uploaded).
    """
    failed = quarantine.groupBy("receipt_id").agg(F.min("error").alias("error"))
    both = files.join(failed, "receipt_id", "left")
    if uploads is None:
        both = both.withColumns({"_ids": F.lit(None).cast("array<string>"), "_upload": F.lit(None).cast("string")})
    else:
        both = both.join(uploads.select("receipt_id", F.col("ids").alias("_ids"), F.col("error").alias("_upload")), "receipt_id", "left")
    parse = F.concat(F.lit(X.PARSE_FAILED), F.col("error.message"))
    message = F.coalesce(parse, F.concat(F.lit(X.UNEXPECTED), F.col("_upload")), F.lit(X.COMPLETED))
    ok = F.col("error").isNull() & F.col("_upload").isNull()
    return both.select("file", ok.alias("success"), message.alias("message"), F.when(ok, F.col("_ids")).alias("registry"))


def summary(outcomes: DataFrame) -> DataFrame:
    """Success and message of a batch: all of at least one succeeded, and how many of how many."""
    both = outcomes.agg(F.count_if("success").alias("n"), F.count(F.lit(1)).alias("all"))
    return both.select(((F.col("n") == F.col("all")) & (F.col("all") > 0)).alias("success"), F.concat(F.col("n").cast("string"), F.lit("/"), F.col("all").cast("string"), F.lit(" succeeded")).alias("message"))


def heads(prepared: DataFrame, parsed: DataFrame) -> DataFrame:
    """receipt_id, store, address, purchase_date, currency: of the merged chunks, where the text doesn't tell them."""
    merged = chunks.merge_scalars(
        parsed.select("receipt_id", "chunk_idx", "r.storeName", "r.storeAddress", "r.purchaseDate", "r.currency"), first=["storeName", "storeAddress", "currency"], first_filled=["purchaseDate"]
    )
    both = merged.join(prepared, "receipt_id")
    store = T.store_from_header(T.store_alias(F.coalesce("storeName", F.lit(""))), F.col("ocr"))
    named = both.withColumn("store", store).withColumn("purchase_date", F.coalesce(T.transaction_date(F.col("ocr")), F.col("purchaseDate")))
    currency = T.receipt_currency(F.col("ocr"), F.col("store"), F.col("currency"))
    return named.withColumn("currency", currency).select("receipt_id", "store", F.col("storeAddress").alias("address"), "purchase_date", "currency")


def open_items(prepared: DataFrame, answers: DataFrame, weights: bool = True) -> tuple[DataFrame, DataFrame]:
    """Valid item rows, prices still missing where the model gave none, and the heads of their receipts.

    answers: receipt_id, chunk_idx, raw; receipts that are no object or don't parse give no rows. Chunks merge in order.
    """
    parsed = answers.withColumn("r", F.from_json(T.model_json(F.col("raw")), RECEIPT)).where("r is not null")
    named = heads(prepared, parsed)
    item = lambda a, b: F.col(f"i.{a}").alias(b)
    rows = parsed.select("receipt_id", "chunk_idx", F.posexplode("r.items").alias("pos", "i"))
    rows = rows.select("receipt_id", "chunk_idx", "pos", item("productName", "name"), item("itemCode", "code"), item("price", "price"), item("amount", "amount"))
    first = chunks.first_items(rows, keys=["receipt_id"], order=["chunk_idx", "pos"])
    flat = first.withColumn("item_idx", F.col("chunk_idx").cast("long") * 100_000 + F.col("pos")).join(named, "receipt_id")
    valid = items.drop_fuzzy_repeats(items.validate(flat.select("receipt_id", "item_idx", "store", "purchase_date", "currency", "name", "code", "price", "amount")))
    if weights:
        valid = items.inject_weights(valid, items.weight_rows(prepared), fuzzy=True)
    return valid, named


def finish(rows: DataFrame) -> DataFrame:
    """The item steps after prices are known."""
    return items.late_filter(items.drop_fragments(items.flatten(rows)))


def structure(prepared: DataFrame, answers: DataFrame, weights: bool = True) -> DataFrame:
    """Item rows from a model's answers alone: no second answers, repairs or coordinates."""
    return finish(open_items(prepared, answers, weights)[0])


#: Asks a service: stage and requests -> the requests with answer, ok and error.
Ask = Callable[[str, DataFrame], DataFrame]


def recorded(tables: dict[str, DataFrame]) -> Ask:
    """Answers from tables, one for each stage, joined on the columns that they share with the requests; those without one fail."""

    def ask(stage: str, requests: DataFrame) -> DataFrame:
        if stage not in tables:
            return requests.withColumns({"answer": F.lit(None).cast("string"), "ok": F.lit(False), "error": F.lit("no answer recorded")})
        keys = [c for c in tables[stage].columns if c in requests.columns]
        return providers.answer_from(requests, tables[stage].select(*keys, "answer"), on=keys)

    return ask


def journalled(journal: Journal, services: dict[str, Callable[[dict], str]], **how) -> Ask:
    """Answers of live services, each called once for what it is asked, whatever happens to the run. services: stage -> text to answer."""

    def ask(stage: str, requests: DataFrame) -> DataFrame:
        service = services[stage]
        return journal.call(requests, lambda row: {"answer": service(row["text"])}, stage=stage, columns=["text"], schema="answer string", **how)

    return ask


def _again(prepared: DataFrame, answers: DataFrame, asked: DataFrame, ask: Ask) -> DataFrame:
    """The answers, with second ones of receipts whose items aren't in their text."""
    suspect = storage.written(suspects(prepared, answers), "suspects")
    if suspect.isEmpty():
        return answers
    second = ask("again", asked.join(suspect, "receipt_id", "left_semi")).where("ok")
    return without_hallucinations(prepared, answers, second.select("receipt_id", "chunk_idx", F.col("answer").alias("raw")))


def _repaired(rows: DataFrame, prepared: DataFrame, ask: Ask) -> DataFrame:
    """Items without a price ask the model, then a stronger one, and go where neither says a number."""
    said = []
    for stage in ("repair", "escalate"):
        left = rows if not said else providers.without_number(rows, said[0])
        asked = storage.written(providers.repair_requests(left, prepared).withColumnRenamed("prompt", "text"), stage)
        if asked.isEmpty():
            break
        said.append(storage.written(ask(stage, asked).where("ok").select("receipt_id", "item_idx", "answer"), f"{stage}-answers"))
    if not said:
        return rows.where(~providers.lacks_price(F.col("price")))
    return providers.repair_prices(rows, *said)


def _located(rows: DataFrame, named: DataFrame, prepared: DataFrame, ask: Ask) -> DataFrame:
    """Latitude and longitude of each item's store; each address is looked up once, and none is found for some."""
    asked = providers.geocode_queries(named.join(prepared.select("receipt_id", "ocr"), "receipt_id"))
    queries = asked.select(F.col("query").alias("text")).where("text <> ''").distinct()
    place = F.from_json("answer", "latitude double, longitude double")
    places = ask("geocode", queries).where("ok").select(F.col("text").alias("query"), place.alias("_p")).select("query", "_p.latitude", "_p.longitude")
    return rows.join(asked.select("receipt_id", "query").join(places, "query", "left").drop("query"), "receipt_id", "left")


STAGES = ["read", "model", "answer"]


def extract(files: DataFrame, texts: DataFrame, ask: Ask) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """A batch from texts to item rows with coordinates, in this order: answers for chunks, second answers, item steps, weights, repaired
    prices, coordinates. Also the quarantine (receipt_id, error) and the counts of the error channel.

    files: receipt_id, file; texts: receipt_id, ocr (ok, error); ask: the services, as recorded() or journalled(). Services answer
    "extract", "again", "repair", "escalate" (with `text` to be answered) and "geocode" (an address; JSON of latitude, longitude).
    """
    whole = lambda rows: rows.where(T.strip(F.coalesce("ocr", F.lit(""))) != "")
    asked = storage.written(requests(prepare(whole(texts.select("receipt_id", "ocr")))), "requests")
    said = storage.written(ask("extract", asked).withColumnRenamed("answer", "raw").select("receipt_id", "chunk_idx", "raw", "ok", "error"), "answers")
    good, failed, counts = channel.route(admit(files, texts, said), "admitted", STAGES)
    prepared = prepare(good.select("receipt_id", "ocr"))
    answers = good.select("receipt_id", F.inline("answers")).select("receipt_id", "chunk_idx", "raw")
    rows, named = open_items(prepared, _again(prepared, answers, asked, ask))
    rows = storage.written(rows, "open-items")
    done = finish(_repaired(rows, prepared, ask))
    return _located(done, storage.written(named, "heads"), prepared, ask), failed, counts
