"""Log reports, scoring, resilience and spatial operators as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import reports
from ..functions import fixed as X
from ..functions import stats
from ..operators import evaluate, logs, resilience, spatial
from .derive import derived, duck
from .registry import query
from .text_queries import BOOK, q

P95 = "list_sort(list({0}))[CAST(least(floor({1} * count({0})), count({0}) - 1) AS bigint) + 1]"


def _logs(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "logs")


def _calls(spark: SparkSession, sf: str) -> DataFrame:
    return _logs(spark, sf).where("event = 'llm_extraction'")


CALLS = """, calls AS (SELECT * FROM logs WHERE event = 'llm_extraction'),
traces AS (SELECT trace_id, arg_max(provider, (time, event_id)) AS provider, arg_max(model, (time, event_id)) AS model, count(*) AS calls, max(time) AS last_time FROM calls GROUP BY trace_id),
sizes AS (SELECT calls, count(*) AS n FROM traces GROUP BY calls), size AS (SELECT calls AS run_size FROM sizes ORDER BY n DESC, calls LIMIT 1),
valid AS (SELECT trace_id, provider, model, last_time, row_number() OVER (PARTITION BY provider, model ORDER BY last_time DESC, trace_id DESC) AS place FROM traces, size WHERE calls >= run_size)"""


@query(duck("logs") + CALLS + " SELECT trace_id, provider, model, last_time, place FROM valid WHERE place <= 3")
def w01_a05_a10_recent_traces(spark: SparkSession, sf: str) -> DataFrame:
    return logs.recent_complete_traces(_calls(spark, sf)).withColumn("place", F.col("place").cast("long"))


@query(duck("logs") + CALLS + " SELECT event_id, trace_id FROM calls WHERE time >= '2024-01-10' AND trace_id IN (SELECT trace_id FROM valid WHERE place <= 3)")
def j06_f05_events_of_traces(spark: SparkSession, sf: str) -> DataFrame:
    calls = _calls(spark, sf)
    return logs.of_traces(logs.since(calls, "2024-01-10"), logs.recent_complete_traces(calls)).select("event_id", "trace_id")


@query(duck("logs") + f" SELECT count(*) AS n, round(avg(latency_ms), 4) AS avg_ms, quantile_cont(latency_ms, 0.5) AS p50_ms, {P95.format('latency_ms', 0.95)} AS p95_ms, min(latency_ms) AS min_ms, max(latency_ms) AS max_ms FROM logs WHERE event = 'adi_ocr' AND success")
def a01_a02_a03_ocr_summary(spark: SparkSession, sf: str) -> DataFrame:
    return logs.ocr_summary(_logs(spark, sf).where("event = 'adi_ocr'"))


SUMMARY = CALLS + f""", book(provider, model, rate_in, rate_out) AS (VALUES {BOOK}),
priced AS (SELECT c.*, input_tokens / 1e6 * coalesce(rate_in, 0) + output_tokens / 1e6 * coalesce(rate_out, 0) AS cost_usd FROM calls c LEFT JOIN book b ON c.provider = b.provider AND c.model = b.model),
ok AS (SELECT provider, model, count(*) AS successes, round(avg(latency_ms), 4) AS avg_ms, quantile_cont(latency_ms, 0.5) AS p50_ms, {P95.format('latency_ms', 0.95)} AS p95_ms, round(avg(input_tokens), 4) AS avg_in, round(avg(output_tokens), 4) AS avg_out, round(avg(input_chars), 4) AS avg_chars,
  count(DISTINCT image_name) AS receipts, round(sum(cost_usd), 9) AS total_cost, list_sort(list_distinct(list(coalesce(cost_source, 'unknown')))) AS src FROM priced WHERE success GROUP BY provider, model),
n AS (SELECT provider, model, count(*) AS calls FROM calls GROUP BY provider, model),
e2e AS (SELECT provider, model, quantile_cont(latency_ms, 0.5) AS e2e_p50, {P95.format('latency_ms', 0.95)} AS e2e_p95 FROM logs WHERE event = 'pipeline_complete' AND success GROUP BY provider, model),
summary AS (SELECT ok.provider, ok.model, calls, successes, calls - successes AS errors, avg_ms, p50_ms, p95_ms, avg_in, avg_out, avg_chars, receipts, total_cost, e2e_p50, e2e_p95,
  CASE WHEN src = ['api'] THEN 'api' WHEN NOT list_contains(src, 'api') THEN 'est' ELSE 'mixed' END AS cost_src, round(total_cost / successes, 9) AS cost_per, round(60000 / e2e_p50, 6) AS per_minute, round(100.0 * (calls - successes) / calls, 6) AS fail_pct
  FROM ok JOIN n ON n.provider = ok.provider AND n.model = ok.model LEFT JOIN e2e ON e2e.provider = ok.provider AND e2e.model = ok.model)"""


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return logs.provider_summary(logs.with_cost(_calls(spark, sf)), _logs(spark, sf).where("event = 'pipeline_complete'"))


@query(duck("logs") + SUMMARY + " SELECT * FROM summary")
def a06_a08_a09_j05_provider_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(spark, sf)


@query(duck("logs") + SUMMARY + """, named AS (SELECT provider || '/' || lower(split_part(model, '/', -1)) AS n, coalesce(e2e_p50, p50_ms) AS s, cost_per, coalesce('~' || CAST(CAST(round(per_minute) AS bigint) AS varchar) || '/min', '—') AS t FROM summary),
placed AS (SELECT *, row_number() OVER (ORDER BY s, n) AS k FROM named)
SELECT arg_min(n, k) AS fastest, arg_min(n, (cost_per, n)) AS cheapest, string_agg(n, ', ' ORDER BY k) AS by_speed, string_agg(n || ' ' || t, ', ' ORDER BY k) AS throughput,
       coalesce(string_agg(n, ', ' ORDER BY k) FILTER (WHERE k > 1), '') AS fallbacks FROM placed""")
def a17_findings(spark: SparkSession, sf: str) -> DataFrame:
    return logs.findings(_summary(spark, sf))


TRUTH_COUNTS = ", truth_counts AS (SELECT 'img' || CAST(i AS varchar) AS stem, i % 9 AS truth FROM range(0, 40, 3) t(i))"


def _truth_counts(spark: SparkSession) -> DataFrame:
    return spark.range(0, 40, 3).select(F.concat(F.lit("img"), F.col("id").cast("string")).alias("stem"), (F.col("id") % 9).alias("truth"))


@query(duck("logs") + CALLS + TRUTH_COUNTS + """, c AS (SELECT provider, model, image_name, items_extracted, count(*) AS n FROM calls WHERE success GROUP BY ALL),
m AS (SELECT provider, model, image_name, arg_max(items_extracted, (n, -items_extracted)) AS modal FROM c GROUP BY provider, model, image_name)
SELECT provider, model, count(*) FILTER (WHERE modal = truth) AS correct, count(*) AS checked FROM m JOIN truth_counts t ON t.stem = replace(image_name, '.jpg', '') GROUP BY provider, model""")
def a16_count_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return logs.count_accuracy(_calls(spark, sf), _truth_counts(spark))


@query(duck("logs") + SUMMARY + TRUTH_COUNTS + """, c AS (SELECT provider, model, image_name, items_extracted, count(*) AS n FROM calls WHERE success GROUP BY ALL),
m AS (SELECT provider, model, image_name, arg_max(items_extracted, (n, -items_extracted)) AS modal FROM c GROUP BY provider, model, image_name),
acc AS (SELECT provider, model, count(*) FILTER (WHERE modal = truth) AS correct, count(*) AS checked FROM m JOIN truth_counts t ON t.stem = replace(image_name, '.jpg', '') GROUP BY provider, model)
SELECT s.provider, s.model, '| ' || concat_ws(' | ', s.provider, split_part(s.model, '/', -1), receipts, errors || '/' || calls || ' (' || format('{:,.0f}', 100.0 * errors / calls) || '%)',
  coalesce(format('{:,.0f}', e2e_p50), '—'), coalesce(format('{:,.0f}', e2e_p95::double), '—'), coalesce('~' || format('{:,.0f}', 60000 / e2e_p50) || '/min', '—'),
  format('{:,.0f}', p50_ms), format('{:,.0f}', p95_ms::double), format('{:,.0f}', avg_ms), format('{:,.0f}', avg_in), format('{:,.0f}', avg_out), coalesce(format('{:,.0f}', avg_chars), '—'),
  CASE WHEN cost_per > 0 THEN printf('$%.4f', cost_per) ELSE '$0.00' END, cost_src, printf('$%.4f', total_cost), coalesce(correct || '/' || checked, '—')) || ' |' AS line
FROM summary s LEFT JOIN acc ON acc.provider = s.provider AND acc.model = s.model""")
def k06_provider_table(spark: SparkSession, sf: str) -> DataFrame:
    return reports.provider_lines(_summary(spark, sf), logs.count_accuracy(_calls(spark, sf), _truth_counts(spark)))


PER = CALLS + TRUTH_COUNTS + """, o AS (SELECT image_name, trace_id, arg_max(latency_ms, event_id) AS ocr_ms FROM logs WHERE event = 'adi_ocr' GROUP BY image_name, trace_id),
per AS (SELECT event_id, replace(c.image_name, '.jpg', '') AS stem, c.trace_id, latency_ms, ocr_ms, items_extracted, truth, CASE WHEN truth IS NULL THEN '—' WHEN truth = items_extracted THEN '✓' ELSE '✗' END AS mark
FROM calls c LEFT JOIN o ON o.image_name = c.image_name AND o.trace_id = c.trace_id LEFT JOIN truth_counts t ON t.stem = replace(c.image_name, '.jpg', ''))"""


def _per(spark: SparkSession, sf: str) -> DataFrame:
    return logs.per_receipt(_calls(spark, sf), _logs(spark, sf).where("event = 'adi_ocr'"), _truth_counts(spark))


@query(duck("logs") + PER + " SELECT * FROM per")
def j03_j04_w05_per_receipt(spark: SparkSession, sf: str) -> DataFrame:
    return _per(spark, sf)


@query(duck("logs") + PER + """ SELECT event_id, coalesce(format('{:,}', latency_ms * 10), '—') || CASE WHEN latency_ms * 10 > 60000 THEN ' ⚠' ELSE '' END AS latency, coalesce(format('{:,}', ocr_ms), '—') AS ocr, substr(trace_id, 1, 3) AS source FROM per""")
def f07_display(spark: SparkSession, sf: str) -> DataFrame:
    return logs.display(_per(spark, sf).withColumn("latency_ms", F.col("latency_ms") * 10))


@query(duck("logs") + f""" SELECT provider, model, {P95.format('latency_ms', 0.9)} AS p90 FROM logs GROUP BY provider, model""")
def a03_a04_indexed_percentile(spark: SparkSession, sf: str) -> DataFrame:
    """The form for groups of any size."""
    return stats.indexed_percentile(_logs(spark, sf), ["provider", "model"], "latency_ms", 0.9, "p90")


@query(duck("logs") + """ SELECT trace_id, round(100.0 * count(*) FILTER (WHERE success) / count(*), 6) AS success_pct, count(*) FILTER (WHERE success) = count(*) AS success, CAST(count(*) FILTER (WHERE success) AS varchar) || '/' || CAST(count(*) AS varchar) || ' succeeded' AS message FROM logs GROUP BY trace_id""")
def a07_a15_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _logs(spark, sf)
    return rows.groupBy("trace_id").agg(F.round(stats.rate(F.col("success")), 6).alias("success_pct")).join(resilience.batch_outcome(rows, ["trace_id"]), "trace_id")


def _pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return derived(spark, sf, "truth"), derived(spark, sf, "output")


@query(duck("truth", "output", "output_files") + """ SELECT t.stem, t.n AS gt_items, CASE WHEN f.status = 'filled' THEN coalesce(o.n, 0) END AS out_items,
  CASE WHEN f.stem IS NULL THEN 'no output' WHEN f.status = 'empty' THEN 'empty output' ELSE 'scored' END AS status
FROM (SELECT stem, count(*) AS n FROM truth GROUP BY stem) t LEFT JOIN output_files f ON f.stem = t.stem
     LEFT JOIN (SELECT stem, count(*) AS n FROM output GROUP BY stem) o ON o.stem = t.stem""")
def j01_statuses(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.statuses(*_pair(spark, sf), derived(spark, sf, "output_files"))


MATCH = r""", t AS (SELECT stem, item_idx, lower(name) AS name, CAST(regexp_replace(price, '[^0-9.]', '', 'g') AS double) AS price, regexp_replace(replace(lower(amount), ' ', ''), 'lbs$', 'lbs') AS amount, store, purchase_date FROM truth),
o AS (SELECT stem, item_idx, lower(name) AS name, CAST(regexp_replace(price, '[^0-9.]', '', 'g') AS double) AS price, lower(amount) AS amount FROM output),
best AS (SELECT t.stem, t.item_idx, arg_min(o.item_idx, (t.name <> o.name, o.item_idx)) AS o_idx, min(CASE WHEN t.name = o.name THEN 0 ELSE 1 END) AS leg FROM t JOIN o ON o.stem = t.stem AND (t.name = o.name OR contains(t.name, o.name) OR contains(o.name, t.name)) GROUP BY t.stem, t.item_idx)"""


@query(duck("truth", "output") + MATCH + " SELECT t.stem, t.item_idx AS t_idx, t.name AS t_name, b.o_idx, b.leg FROM t LEFT JOIN best b ON b.stem = t.stem AND b.item_idx = t.item_idx")
def j02_matches(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.matches(*_pair(spark, sf)).select("stem", "t_idx", "t_name", "o_idx", "leg")


@query()
def j02_fuzzy_matches(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.matches(*_pair(spark, sf), fuzzy=True).select("stem", "t_idx", "t_name", "o_idx", "leg")


SCORE = MATCH + r""", hit AS (SELECT t.stem, count(b.o_idx) AS names, count(*) FILTER (WHERE abs(t.price - o.price) <= 0.01) AS prices, count(*) FILTER (WHERE t.amount <> '' AND o.amount = t.amount) AS amounts
  FROM t LEFT JOIN best b ON b.stem = t.stem AND b.item_idx = t.item_idx LEFT JOIN o ON o.stem = b.stem AND o.item_idx = b.o_idx GROUP BY t.stem),
th AS (SELECT stem, arg_min(store, item_idx) AS store, arg_min(purchase_date, item_idx) AS d, min(latitude) AS lat, min(longitude) AS lon, count(*) AS n FROM truth GROUP BY stem),
oh AS (SELECT stem, arg_min(store, item_idx) AS store, replace(arg_min(purchase_date, item_idx), '-', '.') AS d, min(latitude) AS lat, min(longitude) AS lon, count(*) AS n FROM output GROUP BY stem),
flags AS (SELECT th.stem, len(list_intersect(list_filter(string_split_regex(lower(th.store), '\W+'), lambda w: length(w) > 3), list_filter(string_split_regex(lower(oh.store), '\W+'), lambda w: length(w) > 3))) > 0 AS store_ok, th.d = oh.d AS date_ok, th.n = oh.n AS count_ok, th.n,
  CASE WHEN th.lat IS NULL AND oh.lat IS NULL THEN true ELSE coalesce(abs(th.lat - oh.lat) <= 0.02, false) END AS lat_ok,
  CASE WHEN th.lon IS NULL AND oh.lon IS NULL THEN true ELSE coalesce(abs(th.lon - oh.lon) <= 0.02, false) END AS lon_ok FROM th JOIN oh ON oh.stem = th.stem),
scored AS (SELECT f.stem, store_ok, date_ok, lat_ok, lon_ok, count_ok, names, prices, amounts, n, round((store_ok::int + date_ok::int + count_ok::int + lat_ok::int + lon_ok::int + (names + prices + amounts) / n) / 8 * 100, 6) AS overall FROM flags f JOIN hit h ON h.stem = f.stem)"""


@query(duck("truth", "output") + SCORE + " SELECT * FROM scored")
def a11_scores(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.scores(*_pair(spark, sf))


PROVIDERS = """, by_provider AS (SELECT *, 'p' || CAST(CAST(stem AS bigint) % 2 AS varchar) AS provider FROM scored)"""


@query(duck("truth", "output") + SCORE + PROVIDERS + " SELECT provider, count(*) AS receipts, round(avg(overall), 6) AS avg_score, min(overall) AS min_score, max(overall) AS max_score, round(sum(prices) / sum(n), 9) AS price_match FROM by_provider GROUP BY provider")
def a12_a13_eval_summary(spark: SparkSession, sf: str) -> DataFrame:
    scored = evaluate.scores(*_pair(spark, sf)).withColumn("provider", F.concat(F.lit("p"), (F.col("stem").cast("bigint") % 2).cast("string")))
    return evaluate.summary(scored, ["provider"])


@query(duck("truth", "output") + SCORE + """, p(provider, k) AS (VALUES ('c', 0), ('b', 1), ('a', 2)), s AS (SELECT stem, provider, n, greatest(prices - k, 0) AS prices FROM scored, p),
ranked AS (SELECT provider, row_number() OVER (ORDER BY sum(prices) / sum(n) DESC, provider) AS rank FROM s GROUP BY provider),
r AS (SELECT s.stem, s.provider, rank, prices / n AS ratio FROM s JOIN ranked USING (provider)),
pairs AS (
  SELECT x.stem, x.provider AS xp, x.ratio AS xr, y.provider AS yp, y.ratio AS yr FROM r x JOIN r y ON y.stem = x.stem AND x.rank < y.rank AND abs(x.ratio - y.ratio) >= 0.30
  QUALIFY row_number() OVER (PARTITION BY x.stem ORDER BY x.rank, y.rank) = 1)
SELECT stem, CASE WHEN xr >= yr THEN xp ELSE yp END AS stronger, greatest(xr, yr) AS high, CASE WHEN xr >= yr THEN yp ELSE xp END AS weaker, least(xr, yr) AS low FROM pairs""")
def j07_w10_provider_gaps(spark: SparkSession, sf: str) -> DataFrame:
    p = spark.createDataFrame([("c", 0), ("b", 1), ("a", 2)], "provider string, k int")
    s = evaluate.scores(*_pair(spark, sf)).crossJoin(F.broadcast(p))  # three fixed rows
    return evaluate.provider_gaps(s.select("stem", "provider", "n", F.greatest(F.col("prices") - F.col("k"), F.lit(0)).alias("prices")))


GAPS = SCORE + """, p(provider, k) AS (VALUES ('c', 0), ('b', 1), ('a', 2)), s AS (SELECT stem, provider, n, greatest(prices - k, 0) AS prices FROM scored, p),
ranked AS (SELECT provider, sum(prices) / sum(n) AS share, row_number() OVER (ORDER BY sum(prices) / sum(n) DESC, provider) AS rank FROM s GROUP BY provider),
r AS (SELECT s.stem, s.provider, rank, prices / n AS ratio FROM s JOIN ranked USING (provider)),
pairs AS (
  SELECT x.stem, x.provider AS xp, x.ratio AS xr, y.provider AS yp, y.ratio AS yr FROM r x JOIN r y ON y.stem = x.stem AND x.rank < y.rank AND abs(x.ratio - y.ratio) >= 0.30
  QUALIFY row_number() OVER (PARTITION BY x.stem ORDER BY x.rank, y.rank) = 1)"""


@query(duck("truth", "output") + GAPS + r"""
SELECT printf('0 %09d', rank) AS place, '- **' || provider || '**: ' || CAST(round_even(share * 100, 0) AS bigint) || '% overall price match' AS line FROM ranked
UNION ALL SELECT '2 ' || stem, '- **' || stem || ':** ' || CASE WHEN xr >= yr THEN xp ELSE yp END || ' ' || CAST(round_even(greatest(xr, yr) * 100, 0) AS bigint) || '% vs ' || CASE WHEN xr >= yr THEN yp ELSE xp END || ' ' || CAST(round_even(least(xr, yr) * 100, 0) AS bigint) || '%' FROM pairs
UNION ALL SELECT '1', 'Receipts with a ≥ 30 percentage-point price match gap:' WHERE EXISTS (SELECT 1 FROM pairs)
UNION ALL SELECT '3', (SELECT arg_min(provider, (share, rank)) FROM ranked) || ' is extracting per-unit rates or subtotals instead of line-item totals on multi-column receipts. ' || (SELECT arg_min(provider, rank) FROM ranked) || ' handles these layouts correctly.' WHERE EXISTS (SELECT 1 FROM pairs)""")
def k06_a17_quality_finding(spark: SparkSession, sf: str) -> DataFrame:
    p = spark.createDataFrame([("c", 0), ("b", 1), ("a", 2)], "provider string, k int")
    s = evaluate.scores(*_pair(spark, sf)).crossJoin(F.broadcast(p))  # three fixed rows
    return reports.quality_finding(s.select("stem", "provider", "n", F.greatest(F.col("prices") - F.col("k"), F.lit(0)).alias("prices")))


@query(duck("logs") + """, c AS (SELECT event_id, [image_name, provider, coalesce(CAST(input_chars AS varchar), '—')] AS cells FROM logs WHERE event = 'llm_extraction'),
w AS (SELECT greatest(max(length(cells[1])), 5)::INT AS a, greatest(max(length(cells[2])), 8)::INT AS b, greatest(max(length(cells[3])), 5)::INT AS c FROM c),
rule AS (SELECT '+-' || repeat('-', a) || '-+-' || repeat('-', b) || '-+-' || repeat('-', c) || '-+' AS r FROM w)
SELECT '9' || chr(31) || event_id AS place, '| ' || rpad(cells[1], a, ' ') || ' | ' || rpad(cells[2], b, ' ') || ' | ' || rpad(cells[3], w.c, ' ') || ' |' AS line FROM c, w
UNION ALL SELECT unnest(['0', '2', 'a']), r FROM rule UNION ALL SELECT '1', '| ' || rpad('Image', a, ' ') || ' | ' || rpad('Provider', b, ' ') || ' | ' || rpad('Chars', c, ' ') || ' |' FROM w""")
def k06_boxed_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived(spark, sf, "logs").where("event = 'llm_extraction'")
    cells = F.array("image_name", "provider", F.col("input_chars").cast("string"))
    return reports.boxed(rows.select("event_id", cells.alias("cells")), ("Image", "Provider", "Chars"), ["event_id"])


@query(duck("words") + """ SELECT page_id, token, arg_max(x, word_idx) AS x, arg_max(y, word_idx) AS y, count(*) AS n FROM words GROUP BY page_id, token""")
def g01_token_places(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.token_places(derived(spark, sf, "words"))


TILT = f""", places AS (SELECT page_id, token, arg_max(x, word_idx) AS px, arg_max(y, word_idx) AS py, count(*) AS n FROM words GROUP BY page_id, token),
lines AS (
  SELECT w.page_id, line_idx, count(*) AS k, max(n) AS most, any_value(line_y) AS ly, arg_min(py, px) AS y0, arg_max(py, px) AS y1, min(px) AS x0, max(px) AS x1,
         string_agg(w.token, ' ' ORDER BY word_idx) AS text
  FROM words w JOIN places p ON p.page_id = w.page_id AND p.token = w.token GROUP BY w.page_id, line_idx),
slopes AS (
  SELECT page_id, quantile_cont((y1 - y0) / (x1 - x0), 0.5) AS tilt FROM lines
  WHERE k >= 2 AND most = 1 AND ly <= 600 AND x1 - x0 >= 50 AND NOT regexp_matches(text, {q(X.SPATIAL_NOISE_LINE)}) GROUP BY page_id),
tilts AS (SELECT DISTINCT w.page_id, coalesce(tilt, 0.0) AS tilt FROM words w LEFT JOIN slopes s ON s.page_id = w.page_id)"""


@query(duck("words") + TILT + " SELECT page_id, round(tilt, 9) AS tilt FROM tilts")
def g02_tilt(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.tilt(derived(spark, sf, "words")).select("page_id", F.round("tilt", 9).alias("tilt"))


ENTRIES = TILT + f""", placed AS (
  SELECT w.*, px, px / max(px) OVER (PARTITION BY w.page_id) AS share FROM words w JOIN places p ON p.page_id = w.page_id AND p.token = w.token),
kept AS (
  SELECT p.*, CASE WHEN share < 0.48 THEN 'L' WHEN share < 0.75 THEN 'C' ELSE 'R' END AS col FROM placed p JOIN lines l ON l.page_id = p.page_id AND l.line_idx = p.line_idx
  WHERE NOT regexp_matches(l.text, {q(X.SPATIAL_NOISE_LINE)})),
entries AS (
  SELECT page_id, col, line_y AS y, line_idx, min(word_idx) AS seq, arg_min(px, word_idx) AS x, string_agg(token, ' ' ORDER BY word_idx) AS text
  FROM kept GROUP BY page_id, col, line_y, line_idx, CASE WHEN col = 'C' THEN word_idx ELSE -1 END)"""


@query(duck("words") + ENTRIES + " SELECT page_id, col, y, line_idx, seq, x, text FROM entries")
def g03_g04_columns(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.entries(derived(spark, sf, "words")).drop("tilt", "height")


#: Rows by an anchored walk over the left entries, then the nearest row below for the others.
ROWS = ENTRIES + """, le AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY y, line_idx, seq) AS k FROM entries WHERE col = 'L'),
walk AS (
  SELECT page_id, k, CAST(0 AS bigint) AS grp, y AS anchor FROM le WHERE k = 1
  UNION ALL
  SELECT l.page_id, l.k, CASE WHEN abs(l.y - w.anchor) > 15 THEN w.grp + 1 ELSE w.grp END, CASE WHEN abs(l.y - w.anchor) > 15 THEN l.y ELSE w.anchor END
  FROM walk w JOIN le l ON l.page_id = w.page_id AND l.k = w.k + 1),
lrow AS (SELECT l.*, l.y - tilt * l.x AS cy, grp FROM le l JOIN walk w ON w.page_id = l.page_id AND w.k = l.k JOIN tilts t ON t.page_id = l.page_id)"""
ASSIGN = ROWS + """, heights AS (SELECT page_id, grp, arg_max(cy, k) AS h FROM lrow GROUP BY page_id, grp),
other AS (SELECT e.*, e.y - tilt * e.x AS cy FROM entries e JOIN tilts t ON t.page_id = e.page_id WHERE col <> 'L'),
given AS (
  SELECT o.page_id, o.seq, coalesce(arg_min(grp, (h, grp)) FILTER (WHERE h >= cy - 7.5), arg_min(grp, (h, grp))) AS grp
  FROM other o JOIN heights h ON h.page_id = o.page_id GROUP BY o.page_id, o.seq)"""


@query(duck("words") + ROWS + ' SELECT page_id, seq, grp AS "row" FROM lrow')
def g05_group_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = spatial.layout(derived(spark, sf, "words")).select("page_id", F.inline("l"))
    return rows.select("page_id", "seq", F.col("row").cast("long").alias("row"))


@query(duck("words") + ASSIGN + ' SELECT page_id, seq, grp AS "row" FROM given UNION ALL SELECT page_id, seq, grp FROM lrow')
def g06_g07_layout(spark: SparkSession, sf: str) -> DataFrame:
    rows = spatial.layout(derived(spark, sf, "words")).select("page_id", F.inline(F.concat("l", "c", "r")))
    return rows.select("page_id", "seq", F.col("row").cast("long").alias("row"))


#: Rows without a price join the row above by a second walk; rows of several names that are no savings are printed name by name.
TEXT = ASSIGN + f""", tops AS (
  SELECT l.page_id, l.grp, arg_min(l.y, l.k) AS y, bool_or(g.seq IS NOT NULL) AS priced
  FROM lrow l LEFT JOIN given g ON g.page_id = l.page_id AND g.grp = l.grp GROUP BY l.page_id, l.grp),
joined AS (
  SELECT page_id, grp, grp AS target, y AS anchor, priced FROM tops WHERE grp = 0
  UNION ALL
  SELECT t.page_id, t.grp, CASE WHEN s.joins THEN j.target ELSE t.grp END, CASE WHEN s.joins THEN j.anchor ELSE t.y END, CASE WHEN s.joins THEN j.priced ELSE t.priced END
  FROM joined j JOIN tops t ON t.page_id = j.page_id AND t.grp = j.grp + 1, LATERAL (SELECT NOT j.priced AND NOT t.priced AND t.y - j.anchor <= 45 AS joins) s),
names AS (SELECT l.*, target FROM lrow l JOIN joined j ON j.page_id = l.page_id AND j.grp = l.grp),
lows AS (SELECT page_id, target, arg_max(cy, k) AS h, count(*) AS n, string_agg(text, ' ' ORDER BY k) AS all_names FROM names GROUP BY page_id, target),
marked AS (SELECT *, CASE WHEN regexp_matches(all_names, {q(X.SAVINGS_LINE)}) THEN 'S' ELSE 'L' END AS label FROM lows),
centres AS (
  SELECT o.page_id, o.seq, any_value(o.y) AS y, any_value(o.x) AS x, any_value(o.cy) AS cy, any_value(o.line_idx) AS line_idx, any_value(o.text) AS text,
         coalesce(arg_min(target, (h, target)) FILTER (WHERE h >= cy - 7.5), arg_min(target, (h, target))) AS target
  FROM other o JOIN lows h ON h.page_id = o.page_id WHERE col = 'C' GROUP BY o.page_id, o.seq),
rights AS (SELECT o.*, target FROM other o JOIN given g ON g.page_id = o.page_id AND g.seq = o.seq JOIN joined j ON j.page_id = g.page_id AND j.grp = g.grp WHERE col = 'R'),
near AS (
  SELECT c.page_id, c.seq, arg_min(n.k, (abs(n.cy - c.cy), n.y, n.k)) AS k
  FROM centres c JOIN names n ON n.page_id = c.page_id AND n.target = c.target GROUP BY c.page_id, c.seq),
ends AS (SELECT page_id, target, arg_max(k, (y, k)) AS last FROM names GROUP BY page_id, target),
cells AS (
  SELECT n.page_id, n.target, CASE WHEN m.n > 1 AND label = 'L' THEN n.k ELSE 0 END AS part, CASE WHEN m.n > 1 AND label = 'L' THEN n.y ELSE 0 END AS top,
         CASE WHEN m.n > 1 AND label = 'L' THEN (0, 0.0, 0, n.k) ELSE (0, n.x, 0, n.k) END AS place, '[' || label || '] ' || n.text AS cell
  FROM names n JOIN marked m ON m.page_id = n.page_id AND m.target = n.target
  UNION ALL
  SELECT c.page_id, c.target, CASE WHEN m.n > 1 AND label = 'L' THEN near.k ELSE 0 END, CASE WHEN m.n > 1 AND label = 'L' THEN nn.y ELSE 0 END,
         CASE WHEN m.n > 1 AND label = 'L' THEN (1, c.y, c.line_idx, c.seq) ELSE (0, c.x, 1, row_number() OVER (PARTITION BY c.page_id, c.target ORDER BY c.y, c.line_idx, c.seq)) END, '[C] ' || c.text
  FROM centres c JOIN marked m ON m.page_id = c.page_id AND m.target = c.target JOIN near ON near.page_id = c.page_id AND near.seq = c.seq
       JOIN names nn ON nn.page_id = c.page_id AND nn.k = near.k
  UNION ALL
  SELECT r.page_id, r.target, CASE WHEN m.n > 1 AND label = 'L' THEN e.last ELSE 0 END, CASE WHEN m.n > 1 AND label = 'L' THEN nn.y ELSE 0 END,
         (2, r.x, r.line_idx, r.seq), '[R] ' || r.text
  FROM rights r JOIN marked m ON m.page_id = r.page_id AND m.target = r.target JOIN ends e ON e.page_id = r.page_id AND e.target = r.target
       JOIN names nn ON nn.page_id = r.page_id AND nn.k = e.last),
printed AS (SELECT page_id, target, top, part, string_agg(cell, '  |  ' ORDER BY place) AS text FROM cells GROUP BY page_id, target, top, part)"""


@query(duck("words") + TEXT + " SELECT page_id, string_agg(text, chr(10) ORDER BY target, top, part) AS spatial FROM printed GROUP BY page_id")
def g08_g09_spatial_text(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.spatial_text(derived(spark, sf, "words"))


RATES = ", rates AS (SELECT * FROM (VALUES (0), (20), (40)) v(percent))"
TRIED = RATES + """, tried AS (SELECT event_id AS key, percent, latency_ms, (event_id * 7919 + 104729) % 100 >= percent AS a, (event_id * 7919 + 209458) % 100 >= percent AS b, (event_id * 7919 + 314187) % 100 >= percent AS c FROM logs, rates),
runs AS (SELECT key, percent, latency_ms, a OR b OR c AS ok, CASE WHEN a THEN 1 WHEN b THEN 2 ELSE 3 END AS attempts FROM tried)"""


def _runs(spark: SparkSession, sf: str, factor: float) -> DataFrame:
    rates = spark.createDataFrame([(0,), (20,), (40,)], "percent int")
    calls = _logs(spark, sf).select(F.col("event_id").alias("key"), "latency_ms").crossJoin(F.broadcast(rates))  # three fixed rows
    return resilience.retried(calls, factor=factor)


@query(duck("logs") + TRIED + " SELECT key, percent, ok, attempts, CASE attempts WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 3 END AS waited_s FROM runs")
def e04_e05_retries(spark: SparkSession, sf: str) -> DataFrame:
    return _runs(spark, sf, 2.0).select("key", "percent", "ok", "attempts", F.col("waited_s").cast("int").alias("waited_s"))


@query(duck("logs") + TRIED + f""" SELECT percent, round(100.0 * count(*) FILTER (WHERE ok) / count(*), 6) AS success_pct, {P95.format('CASE WHEN ok THEN latency_ms END', 0.5).replace('list(CASE WHEN ok THEN latency_ms END)', 'list(latency_ms) FILTER (WHERE ok)')} AS p50_ms,
{P95.format('latency_ms', 0.99)} AS p99_ms, round(avg(attempts), 6) AS avg_attempts, round(60000.0 * count(*) / sum(latency_ms), 6) AS per_minute FROM runs GROUP BY percent""")
def e08_run_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return resilience.run_statistics(_runs(spark, sf, 1.0), ["percent"], throughput=True)


@query(duck("logs") + """, r AS (SELECT provider, event_id % 3 AS run, avg(latency_ms) AS ms, avg(CASE WHEN event_id % 9 <> 0 THEN items_extracted END) AS items FROM logs GROUP BY provider, event_id % 3) SELECT provider, round(avg(ms), 6) AS ms, round(avg(items), 6) AS items FROM r GROUP BY provider""")
def a14_run_averages(spark: SparkSession, sf: str) -> DataFrame:
    runs = _logs(spark, sf).groupBy("provider", (F.col("event_id") % 3).alias("run")).agg(F.avg("latency_ms").alias("ms"), F.avg(F.when(F.col("event_id") % 9 != 0, F.col("items_extracted"))).alias("items"))
    return resilience.run_averages(runs, ["provider"], ["ms", "items"])


@query(duck("logs") + """ SELECT event_id, CASE WHEN (row_number() OVER (PARTITION BY trace_id ORDER BY event_id) - 1) % 2 = 0 THEN 'openrouter' ELSE 'clod' END AS round_robin, CASE WHEN success AND items_extracted >= 2 THEN 'clod' ELSE 'openrouter' END AS cost_aware FROM logs""")
def e03_routing(spark: SparkSession, sf: str) -> DataFrame:
    calls = _logs(spark, sf).select("event_id", F.col("event_id").alias("key"), F.col("trace_id").alias("group"), F.col("success").alias("cheap_ok"), F.col("items_extracted").alias("cheap_items"))
    both = resilience.route(resilience.route(calls, "round-robin").withColumnRenamed("provider", "round_robin"), "cost-aware")
    return both.select("event_id", "round_robin", F.col("provider").alias("cost_aware"))


@query(duck("logs") + """, e AS (SELECT trace_id, event_id, NOT success AS failed, row_number() OVER (PARTITION BY trace_id ORDER BY event_id) AS k FROM logs),
walk AS (
  SELECT trace_id, k, event_id, 'closed' AS state, true AS passed, CASE WHEN failed THEN 1 ELSE 0 END AS fails, CAST(0 AS bigint) AS since, false AS opened FROM e WHERE k = 1
  UNION ALL
  SELECT e.trace_id, e.k, e.event_id, s.state, s.state <> 'open', n.fails, CASE WHEN n.fails >= 3 AND s.state <> 'open' THEN e.event_id ELSE w.since END, CASE WHEN s.state = 'open' THEN true ELSE n.fails >= 3 END
  FROM walk w JOIN e ON e.trace_id = w.trace_id AND e.k = w.k + 1,
  LATERAL (SELECT CASE WHEN w.opened AND e.event_id - w.since >= 30 THEN 'half-open' WHEN w.opened THEN 'open' WHEN w.state = 'half-open' AND w.fails > 0 THEN 'half-open' ELSE 'closed' END AS state) s,
  LATERAL (SELECT CASE WHEN s.state = 'open' THEN w.fails WHEN NOT e.failed THEN 0 WHEN w.opened THEN 1 ELSE w.fails + 1 END AS fails) n
) SELECT trace_id AS provider, event_id AS seq, state, passed, passed AND opened AS tripped FROM walk""")
def e06_breaker(spark: SparkSession, sf: str) -> DataFrame:
    events = _logs(spark, sf).select(F.col("trace_id").alias("provider"), F.col("event_id").alias("t"), F.col("event_id").alias("seq"), (~F.col("success")).alias("failed"))
    return resilience.breaker(events)


@query("SELECT event_type, round(ln(min(value) + 1), 9) AS mu, round((ln(max(value) + 1) - ln(min(value) + 1)) / 1.645, 9) AS sigma FROM events GROUP BY event_type")
def e07_latency_parameters(spark: SparkSession, sf: str) -> DataFrame:
    e = spark.read.parquet(f"{sf}/events.parquet").groupBy("event_type").agg((F.min("value") + 1).alias("p50"), (F.max("value") + 1).alias("p95"))
    mu, sigma = resilience.lognormal_parameters(F.col("p50"), F.col("p95"))
    return e.select("event_type", F.round(mu, 9).alias("mu"), F.round(sigma, 9).alias("sigma"))


@query(duck("logs") + """, r AS (SELECT event_id, trace_id, items_extracted, lag(items_extracted) OVER (PARTITION BY trace_id ORDER BY items_extracted, event_id) AS b, (row_number() OVER (PARTITION BY trace_id ORDER BY event_id) - 1) // 4 AS batch FROM logs)
SELECT event_id, batch, CASE WHEN b IS NOT DISTINCT FROM items_extracted THEN '' ELSE CAST(items_extracted AS varchar) END AS shown FROM r""")
def e09_w12_tables(spark: SparkSession, sf: str) -> DataFrame:
    rows = resilience.micro_batches(_logs(spark, sf), 4, by=["trace_id"], order="event_id")
    return resilience.suppress_repeats(rows, "items_extracted", by=["trace_id"], order=["items_extracted", "event_id"]).select("event_id", "batch", "shown")


@query("WITH a AS (SELECT n_name, row_number() OVER (ORDER BY n_name) - 1 AS i FROM nation) SELECT k AS place, n_name FROM range(100) r(k) JOIN a ON a.i = k % (SELECT count(*) FROM nation)")
def w11_cyclic(spark: SparkSession, sf: str) -> DataFrame:
    return resilience.cyclic(spark.read.parquet(f"{sf}/nation.parquet").select("n_name"), 100, order="n_name")
