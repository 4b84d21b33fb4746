"""K3: rows of the event log, one builder for its five kinds of event; write_logs() appends them (K2).

A kind says which measures its events have, which of them tells success, and the level of a failure. Latencies are kept to a tenth of a
millisecond, costs to 6 or 8 digits; what a kind doesn't have is null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..schemas import LOG_EVENT


@dataclass(frozen=True)
class Kind:
    measures: tuple[str, ...]
    success: str
    failed: str = "ERROR"


ITEMS = ("latency_ms", "items_attempted", "items_failed")
KINDS = {
    "adi_ocr": Kind(("image_size_bytes", "ocr_latency_ms", "ocr_success", "pages", "chars_extracted", "cost_usd"), "ocr_success"),
    "llm_extraction": Kind(
        ("llm_provider", "llm_model", "llm_latency_ms", "llm_latency_source", "llm_input_tokens", "llm_output_tokens", "llm_input_chars", "llm_prompt_path", "llm_cost_usd", "llm_cost_source", "llm_success", "items_extracted"),
        "llm_success",
    ),
    "pipeline_complete": Kind(("llm_provider", "llm_model", "total_latency_ms", "success"), "success"),
    "mcp_upload": Kind((*ITEMS, "items_uploaded"), "success", "WARN"),
    "mcp_delete": Kind((*ITEMS, "items_deleted"), "success", "WARN"),
}
DIGITS = {"ocr_latency_ms": 1, "llm_latency_ms": 1, "total_latency_ms": 1, "latency_ms": 1, "cost_usd": 6, "llm_cost_usd": 8}
DEFAULTS = {"llm_latency_source": "local", "llm_cost_source": "unknown"}


def _types() -> dict[str, str]:
    out, depth, start = {}, 0, 0
    for k, c in enumerate(LOG_EVENT + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            name, kind = LOG_EVENT[start:k].strip().split(" ", 1)
            out[name], start = kind, k + 1
    return out


def built(rows: DataFrame, kind: str, *, time: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Events of a kind from rows with trace_id, user_id, image_name, its measures, `success` and error; those missing are null.

    time: the instant as a text (default: now, in UTC). keep: columns of rows that go along.
    """
    spec, have = KINDS[kind], set(rows.columns)
    given = lambda c: F.col(c) if c in have else F.lit(None)
    ok = F.coalesce(given(spec.success).cast("boolean"), F.lit(False))
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    made = {c: given(c) for c in ("trace_id", "user_id", "image_name", "error")} | {c: given(c) for c in spec.measures}
    made |= {c: F.coalesce(made[c], F.lit(v)) for c, v in DEFAULTS.items() if c in made}
    made |= {c: F.bround(made[c].cast("double"), n) for c, n in DIGITS.items() if c in made}
    made |= {"time": time if time is not None else now, "service": F.lit("etl"), "event": F.lit(kind), "level": F.when(ok, "INFO").otherwise(spec.failed)}
    if kind == "adi_ocr":
        made["ocr_provider"] = F.lit(X.OCR_PROVIDER)
    if kind == "llm_extraction":
        read, said = given("llm_input_tokens"), given("llm_output_tokens")
        zero = lambda c: F.coalesce(c.cast("long"), F.lit(0))
        made["usage"] = F.struct(read.cast("long").alias("input_tokens"), said.cast("long").alias("output_tokens"), (zero(read) + zero(said)).alias("total_tokens"))
        made["cost"] = F.struct(made["llm_cost_usd"].alias("total_usd"), F.lit(None).cast("string").alias("source"))
    if kind in X.ENDPOINTS:
        endpoint, status = X.ENDPOINTS[kind]
        made |= {"endpoint": F.lit(endpoint), "status": F.when(ok, F.lit(status))}
    return rows.select(*keep, *[made.get(c, F.lit(None)).cast(t).alias(c) for c, t in _types().items()])
