"""K6: the evaluation and the baseline report, as tables of text lines.

A report's lines are rows (section, place, line), so the tables that grow with the logs (a line per call, a line per receipt) are
written by many tasks; `write_report` joins only what a reader opens, one folder for each section.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage
from .functions import fixed as X
from .functions import text as T
from .operators import evaluate, logs
from .sources import files

EVAL_HEADER = ("Image", "GT items", "Store", "Date", "Lat", "Lon", "Items", "Name match", "Price match", "Amount match", "Score")
PROVIDER_HEADER = (
    "Provider", "Model", "Receipts", "Fail rate", "E2E P50 (ms)", "E2E P95 (ms)", "Throughput", "LLM P50 (ms)", "LLM P95 (ms)", "Avg lat (ms)",
    "Avg in tok", "Avg out tok", "Avg in chars", "Cost/receipt", "Cost src", "Total cost", "Item count match",
)
DASH = "—"


def _row(cells: list[Column]) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c.cast("string"), F.lit(DASH)) for c in cells]), F.lit(" |"))


def boxed(rows: DataFrame, header: tuple[str, ...], order: list[str]) -> DataFrame:
    """K6: place, line: a table in a box, each column as wide as its widest cell. rows: cells array<string> and the columns of order.

    Widths come from one aggregate, of which one row comes back; lines are padded by all tasks.
    """
    cells = rows.select(*order, F.transform("cells", lambda c: F.coalesce(c, F.lit(DASH))).alias("cells"))
    wide = cells.agg(*[F.greatest(F.max(F.length(F.get("cells", F.lit(k)))), F.lit(len(h))).alias(f"w{k}") for k, h in enumerate(header)])
    wide = wide.select(F.array(*[F.coalesce(f"w{k}", F.lit(len(h))) for k, h in enumerate(header)]).alias("_w"))
    padded = lambda c: F.concat(F.lit("| "), F.array_join(F.zip_with(c, F.col("_w"), lambda x, w: F.rpad(x, w, F.lit(" "))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("+-"), F.array_join(F.transform("_w", lambda w: F.repeat(F.lit("-"), w)), "-+-"), F.lit("-+"))
    fixed = [("0", rule), ("1", padded(F.array(*map(F.lit, header)))), ("2", rule), ("a", rule)]
    frame = wide.select(F.inline(F.array(*[F.struct(F.lit(p).alias("place"), c.alias("line")) for p, c in fixed])))
    body = cells.crossJoin(F.broadcast(wide))  # one row
    return frame.unionByName(body.select(F.concat_ws("\x1f", F.lit("9"), *[F.col(c).cast("string") for c in order]).alias("place"), padded(F.col("cells")).alias("line")))


def eval_cells(statuses: DataFrame, scored: DataFrame, keys: list[str]) -> DataFrame:
    """keys and cells of each truth receipt: marks, matched items and the score, or why there is none."""
    both = statuses.select(*keys, "gt_items", "status").join(scored, keys, "left")
    got = F.col("status") == "scored"
    mark = lambda c: F.when(got, F.when(F.col(c), "✓").otherwise("✗"))
    share = lambda c: F.when(got, F.concat_ws("/", F.col(c).cast("string"), F.col("n").cast("string")))
    score = F.when(got, F.concat(F.format_string("%.1f", F.col("overall")), F.lit("%"))).otherwise(F.col("status"))
    flags = [mark(c) for c in ("store_ok", "date_ok", "lat_ok", "lon_ok", "count_ok")]
    cells = [F.concat("stem", F.lit(".jpg")), F.col("gt_items"), *flags, *[share(c) for c in ("names", "prices", "amounts")], score]
    return both.select(*keys, F.array(*[c.cast("string") for c in cells]).alias("cells"))


def _line(cells: str) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.transform(cells, lambda c: F.coalesce(c, F.lit(DASH))), " | "), F.lit(" |"))


def _whole(c: Column) -> Column:
    return F.format_number(c.cast("double"), 0)


def eval_lines(statuses: DataFrame, scored: DataFrame) -> DataFrame:
    """stem, line: a table row for each truth receipt."""
    return eval_cells(statuses, scored, ["stem"]).select("stem", _line("cells").alias("line"))


def provider_lines(summary: DataFrame, accuracy: DataFrame) -> DataFrame:
    """provider, model, line: the comparison of providers, a row each."""
    both = summary.join(accuracy, ["provider", "model"], "left")
    percent = F.format_number(F.lit(100.0) * F.col("errors") / F.col("calls"), 0)
    fail = F.concat(F.col("errors").cast("string"), F.lit("/"), F.col("calls").cast("string"), F.lit(" ("), percent, F.lit("%)"))
    pace = F.concat(F.lit("~"), F.format_number(F.lit(60000) / F.col("e2e_p50"), 0), F.lit("/min"))
    numbers = [_whole(F.col(c)) for c in ("p50_ms", "p95_ms", "avg_ms", "avg_in", "avg_out", "avg_chars")]
    total = F.concat(F.lit("$"), F.format_string("%.4f", F.col("total_cost").cast("double")))
    correct = F.concat_ws("/", F.col("correct").cast("string"), F.nullif(F.col("checked"), F.lit(0)).cast("string"))
    cells = [
        F.col("provider"), F.element_at(F.split("model", "/"), -1), F.col("receipts"), fail, _whole(F.col("e2e_p50")), _whole(F.col("e2e_p95")), pace,
        *numbers, logs.dollars(F.col("cost_per"), 4), F.col("cost_src"), total, F.when(F.col("checked") > 0, correct),
    ]
    return both.select("provider", "model", _row(cells).alias("line"))


def _head(header: tuple[str, ...]) -> list[str]:
    return ["| " + " | ".join(header) + " |", "| " + " | ".join("-" * len(h) for h in header) + " |"]


def _table(section: str, header: tuple[str, ...], rows: DataFrame, order: list[str]) -> DataFrame:
    """Lines of a section: title, header, rows in order. Places are texts that sort as the rows do."""
    spark = rows.sparkSession
    head = [(0, f"## {section}"), (1, ""), (2, "| " + " | ".join(header) + " |"), (3, "|" + "---|" * len(header))]
    top = spark.createDataFrame([(section, f"{k}", line) for k, line in head], "section string, place string, line string")
    body = rows.select(F.lit(section).alias("section"), F.concat_ws("\x1f", F.lit("9"), *[F.col(c).cast("string") for c in order]).alias("place"), "line")
    return top.union(body)


def _items(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Item rows, and stem with status, of the receipt files of a folder."""
    read = files.read_items(spark, path)
    rows = read.select("stem", F.posexplode("items").alias("item_idx", "i"))
    cols = {"productName": "name", "price": "price", "amount": "amount", "storeName": "store", "purchaseDate": "purchase_date", "latitude": "latitude", "longitude": "longitude"}
    return rows.select("stem", "item_idx", *[F.col(f"i.{a}").alias(b) for a, b in cols.items()]), read.select("stem", "status")


def evaluation(spark: SparkSession, output_dir: str, truth_dir: str, section: str = "output") -> DataFrame:
    """The lines of one output folder's evaluation against a folder of truth: a row for each receipt, then the average score."""
    truth, _ = _items(spark, truth_dir)
    output, listed = _items(spark, output_dir)
    scored = evaluate.scores(truth, output, fuzzy=True)
    table = _table(section, EVAL_HEADER, eval_lines(evaluate.statuses(truth, output, listed), scored), ["stem"])
    text = F.concat(F.lit("**Avg score: "), F.format_string("%.1f", F.avg("overall")), F.lit("%** over "), F.count(F.lit(1)).cast("string"), F.lit(" receipts"))
    return table.union(scored.agg(F.lit(section), F.lit("a"), text).toDF("section", "place", "line").where("line is not null"))


def quality_finding(scored: DataFrame) -> DataFrame:
    """Place, line: each provider's share of matched prices, the best first; receipts that two of them differ on by 30 points or
    more; and, where there are such, which provider is the weakest and which the strongest. scored: provider, stem, prices, n."""
    percent = lambda c: F.concat(F.format_string("%.0f", F.bround(c * 100, 0)), F.lit("%"))
    scored = storage.written(scored.select("provider", "stem", "prices", "n"), "scored")  # ranks, gaps and the ends all read it
    ranks = evaluate.price_ranks(scored)
    overall = ranks.select(F.format_string("0 %09d", F.col("rank")).alias("place"), F.concat(F.lit("- **"), "provider", F.lit("**: "), percent(F.col("price_match")), F.lit(" overall price match")).alias("line"))
    gaps = evaluate.provider_gaps(scored)
    shown = F.concat(F.lit("- **"), "stem", F.lit(":** "), "stronger", F.lit(" "), percent(F.col("high")), F.lit(" vs "), "weaker", F.lit(" "), percent(F.col("low")))
    each = gaps.select(F.concat(F.lit("2 "), "stem").alias("place"), shown.alias("line"))
    some = gaps.agg(F.count(F.lit(1)).alias("_gaps"))
    ends = ranks.agg(F.max_by("provider", "price_match").alias("_best"), F.min_by("provider", F.struct("price_match", "rank")).alias("_worst"), F.min_by("provider", "rank").alias("_first"))
    said = F.concat("_worst", F.lit(X.WEAKEST), "_first", F.lit(X.STRONGEST))
    frame = F.array(F.struct(F.lit("1").alias("place"), F.lit(X.GAP_TITLE).alias("line")), F.struct(F.lit("3").alias("place"), said.alias("line")))
    closing = ends.crossJoin(F.broadcast(some)).where("_gaps > 0").select(F.inline(frame))  # one row with one row
    return overall.unionByName(each).unionByName(closing)


def accuracy(spark: SparkSession, output_dir: str, truth_dir: str, labels: dict[str, str] | None = None) -> DataFrame:
    """Lines (section, place, line) of field-level accuracy: for each provider's folder its table and average, then the finding on prices.

    All folders are scored in one pass, with the folder as part of a receipt's key. labels: folder -> name to be shown.
    """
    folders = storage.children(output_dir)
    labels = {f: (labels or {}).get(f, f) for f in folders if not f.startswith(("_", "."))}
    if not labels:
        return spark.createDataFrame([], "section string, place string, line string")
    names = F.explode(F.array(*map(F.lit, labels)))  # a provider and model each
    items = [_items(spark, f"{output_dir.rstrip('/')}/{f}") for f in labels]
    keyed = lambda rows, f: rows.withColumn("folder", F.lit(f))
    output = reduce(DataFrame.unionByName, (keyed(i[0], f) for f, i in zip(labels, items, strict=True)))
    listed = reduce(DataFrame.unionByName, (keyed(i[1], f) for f, i in zip(labels, items, strict=True)))
    truth = _items(spark, truth_dir)[0].withColumn("folder", names)
    joint = lambda rows: rows.withColumn("stem", F.concat_ws("\x1f", "folder", "stem")).drop("folder")
    apart = lambda rows: rows.withColumns({"folder": F.split("stem", "\x1f")[0], "stem": F.split("stem", "\x1f")[1]})
    scored = storage.written(apart(evaluate.scores(joint(truth), joint(output), fuzzy=True)), "scored")
    statuses = apart(evaluate.statuses(joint(truth), joint(output), joint(listed)))
    rows = eval_cells(statuses, scored, ["folder", "stem"]).select("folder", "stem", _line("cells").alias("line"))
    shown = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    section = F.concat(F.lit("Field-Level Accuracy: "), shown[F.col("folder")])
    head = rows.select("folder").distinct().select(section.alias("section"), F.inline(F.array(*[F.struct(F.lit(f"1{k}").alias("place"), F.lit(t).alias("line")) for k, t in enumerate(_head(EVAL_HEADER))])))
    average = F.concat(F.lit("**Avg score: "), F.format_string("%.1f", F.avg("overall")), F.lit("%** over "), F.count(F.lit(1)).cast("string"), F.lit(" receipts"))
    averages = scored.groupBy("folder").agg(average.alias("line")).select(section.alias("section"), F.lit("0").alias("place"), "line")
    body = rows.select(section.alias("section"), F.concat_ws("\x1f", F.lit("9"), "stem").alias("place"), "line")
    finding = quality_finding(scored.withColumn("provider", shown[F.col("folder")])).select(F.lit("Quality Finding: Price Extraction by Provider").alias("section"), "place", "line")
    return averages.unionByName(head).unionByName(body).unionByName(finding)


def truth_counts(spark: SparkSession, truth_dir: str) -> DataFrame:
    """Stem, truth: the number of true items of each receipt."""
    return files.read_items(spark, truth_dir).where("items is not null").select("stem", F.size("items").cast("long").alias("truth"))


def baseline(calls: DataFrame, ocr: DataFrame, ends: DataFrame, truth_counts: DataFrame) -> DataFrame:
    """The lines of the baseline report: OCR, providers, each call, findings.

    calls, ocr, ends: model calls, OCR and end-to-end events with the columns of the log operators; truth_counts: stem, truth.
    """
    scoped = logs.of_traces(calls, logs.recent_complete_traces(calls))
    summary = logs.provider_summary(scoped, ends)
    providers = _table("LLM Provider Comparison", PROVIDER_HEADER, provider_lines(summary, logs.count_accuracy(scoped, truth_counts)), ["provider", "model"])
    total = logs.ocr_summary(ocr)
    metrics = [("Calls", F.col("n")), ("Avg latency", _whole(F.col("avg_ms"))), ("P50 latency", _whole(F.col("p50_ms"))), ("P95 latency", _whole(F.col("p95_ms")))]
    each = F.array(*[F.struct(F.lit(k).alias("k"), _row([F.lit(name), c]).alias("line")) for k, (name, c) in enumerate(metrics)])
    ocr_lines = _table("OCR", ("Metric", "Value"), total.select(F.inline(each)), ["k"])
    shown = logs.per_receipt(scoped, ocr, truth_counts)
    slow = F.concat(_whole(F.col("latency_ms")), F.when(F.col("latency_ms") > 60000, F.lit(" ⚠")).otherwise(F.lit("")))
    cells = [F.concat("stem", F.lit(".jpg")), F.col("trace_id"), _whole(F.col("ocr_ms")), slow, F.col("items_extracted"), F.col("mark")]
    calls_ = shown.select("stem", "trace_id", "event_id", _row(cells).alias("line"))
    per = _table("Per-Receipt Breakdown", ("Receipt", "Trace", "OCR (ms)", "LLM (ms)", "Items", "GT"), calls_, ["stem", "trace_id", "event_id"])
    f = logs.findings(summary)
    said = F.array(*[F.struct(F.lit(k).alias("k"), F.concat(F.lit(f"- **{name}:** "), F.coalesce(F.col(c), F.lit(DASH))).alias("line")) for k, (name, c) in enumerate(FINDINGS)])
    found = _table("Findings", (), f.select(F.inline(said)), ["k"]).where("place not in ('2', '3')")
    return reduce(DataFrame.union, (ocr_lines, providers, per, found))


FINDINGS = (("E2E P50 latency (fastest first)", "by_speed"), ("Throughput", "throughput"), ("Lowest cost/receipt", "cheapest"), ("Recommended primary", "fastest"), ("Fallback", "fallbacks"))


def write_report(lines: DataFrame, path: str) -> None:
    """Text files below path, a folder for each section, their lines in order."""
    lines.repartitionByRange("section", "place").sortWithinPartitions("section", "place").select("section", "line").write.mode("overwrite").partitionBy("section").text(path)


def prompt(ocr: Column, n_chunks: Column, base: str, scaffold: str = "", addenda: dict[str, str] | None = None) -> Column:
    """The system prompt of a receipt. One of a single chunk with a spatial part goes without the scaffold; addenda follow for
    each word that the first 1000 characters hold, in any case."""
    direct = (n_chunks == 1) & T.has_spatial(ocr)
    chosen = F.when(direct, F.lit(base.replace(scaffold, "") if scaffold else base)).otherwise(F.lit(base))
    more = [F.when(F.contains(F.substring(F.upper(ocr), 1, 1000), F.lit(word.upper())), F.lit(text)) for word, text in (addenda or {}).items()]
    return F.concat(chosen, F.concat_ws("\n", *more)) if more else chosen
