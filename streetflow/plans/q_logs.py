"""Log queries (Tier 3, L1-L12).

Stand-ins: structured log lines = events (level = event_type, label user_id,
line = props JSON, time = ts); unstructured log lines = every line of every
document (level = lang, label source; documents carry no time, so the ingest
block ``doc_id div 100`` is the time axis).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.functions.rounding import rnd
from streetflow.functions.timeutil import bucket_start
from streetflow.operators.logs import (
    LOGFMT_PAIR,
    bytes_volume,
    cardinality_sketches,
    change_points,
    field_profile,
    label_profile,
    label_volumes,
    line_filter,
    line_format,
    merged_cardinality,
    outer_join_series,
    parsed_fields,
    pattern_samples,
    patterns,
    rank_series,
    series_stats,
    split_lines,
    unwrap_avg,
    values_of,
    volume,
)
from streetflow.operators.templates import template_rollup
from streetflow.registry import query
from streetflow.session import written
from streetflow.sources.tables import read_table

HOUR_US = 3_600_000_000


def event_logs(spark: SparkSession, root: str) -> DataFrame:
    ev = read_table(spark, root, "events")
    return ev.select("event_id", "ts", F.col("event_type").alias("level"), "user_id", F.col("props").alias("line"))


def doc_lines(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select(
        "doc_id", F.col("lang").alias("level"), "source", F.expr("doc_id div 100").alias("block"), "text"
    )
    return split_lines(docs, "text", ["doc_id", "level", "source", "block"])


DL = """
dl AS (
  SELECT doc_id, level, source, block, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line_no,
         unnest(parts) AS line
  FROM (SELECT doc_id, lang AS level, source, doc_id // 100 AS block, string_split(text, chr(10)) AS parts
        FROM documents WHERE text IS NOT NULL)
)"""
HOUR_SQL = f"make_timestamp((epoch_us(ts) // {HOUR_US}) * {HOUR_US})"


@query(
    "log_volume",
    f"SELECT {HOUR_SQL} AS bucket, event_type AS level, COUNT(*) AS volume FROM events GROUP BY 1, 2",
)
def q_log_volume(spark: SparkSession, root: str) -> DataFrame:
    """L1: lines per hour and level."""
    el = event_logs(spark, root)
    return volume(el, [bucket_start(F.col("ts"), 3600).alias("bucket"), "level"])


@query(
    "label_volume_topk",
    """
SELECT * FROM (
  SELECT 'level' AS label, event_type AS value, COUNT(*) AS volume FROM events GROUP BY 2
  UNION ALL
  SELECT 'user_id', CAST(user_id AS VARCHAR), COUNT(*) FROM events GROUP BY 2
) ORDER BY volume DESC, label, value LIMIT 5000
""",
)
def q_label_volume_topk(spark: SparkSession, root: str) -> DataFrame:
    """L2: total volume per label value, largest 5000."""
    return label_volumes(event_logs(spark, root), ["level", "user_id"], limit=5000)


def _all_fields(spark: SparkSession, root: str, nth: bool = False) -> DataFrame:
    el = event_logs(spark, root).withColumn("line_id", F.col("event_id").cast("string"))
    dl = doc_lines(spark, root).withColumn("line_id", F.concat_ws(":", "doc_id", "line_no"))
    a = parsed_fields(el.withColumn("stream", F.lit("events")), ["stream", "line_id"], nth=nth)
    b = parsed_fields(dl.withColumn("stream", F.lit("documents")), ["stream", "line_id"], nth=nth)
    return a.unionByName(b)


FIELDS_SQL = DL + f""",
ef AS (
  SELECT 'events' AS stream, CAST(event_id AS VARCHAR) AS line_id, 'json' AS parser, key,
         json_extract_string(props, '$."' || key || '"') AS value
  FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)
),
dp AS (SELECT doc_id || ':' || line_no AS line_id, regexp_extract_all(line, '{LOGFMT_PAIR}') AS pairs FROM dl),
df AS (
  SELECT 'documents' AS stream, line_id, CAST(NULL AS VARCHAR) AS parser, CAST(NULL AS VARCHAR) AS key,
         CAST(NULL AS VARCHAR) AS value FROM dp WHERE len(pairs) = 0
  UNION ALL
  SELECT 'documents', line_id, 'logfmt', split_part(p, '=', 1),
         regexp_replace(substr(p, strlen(split_part(p, '=', 1)) + 2), '^"|"$', '', 'g')
  FROM (SELECT line_id, unnest(pairs) AS p FROM dp WHERE len(pairs) > 0)
),
fields AS (SELECT * FROM ef UNION ALL SELECT * FROM df)"""


@query("json_fields", "WITH " + FIELDS_SQL + "\nSELECT * FROM fields")
def q_json_fields(spark: SparkSession, root: str) -> DataFrame:
    """L3: JSON then logfmt fields of every line; lines without fields kept once."""
    return _all_fields(spark, root)


@query(
    "field_avg",
    f"""
SELECT {HOUR_SQL} AS bucket, event_type AS level, R6(AVG(v)) AS avg_value, COUNT(*) AS n
FROM (SELECT ts, event_type, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS v FROM events)
WHERE v IS NOT NULL GROUP BY 1, 2
""",
)
def q_field_avg(spark: SparkSession, root: str) -> DataFrame:
    """L4: unwrap the numeric field ``k`` and average it per hour and level."""
    el = event_logs(spark, root)
    out = unwrap_avg(el, [bucket_start(F.col("ts"), 3600).alias("bucket"), "level"], F.get_json_object("line", "$.k"))
    return out.withColumn("avg_value", rnd("avg_value"))


@query(
    "log_patterns",
    "WITH "
    + DL
    + """
SELECT pattern, COUNT(*) AS total, COUNT(DISTINCT block) AS n_buckets,
       array_to_string(list_sort(list_distinct(list(level))), ',') AS levels
FROM (SELECT *, regexp_replace(regexp_replace(line, '[0-9a-fA-F]{16,}', '<hex>', 'g'), '[0-9]+', '<num>', 'g') AS pattern
      FROM dl)
GROUP BY pattern ORDER BY total DESC, pattern LIMIT 500
""",
)
def q_log_patterns(spark: SparkSession, root: str) -> DataFrame:
    """The 500 largest line patterns with their levels."""
    return patterns(doc_lines(spark, root), "line", "block", "level", limit=500)


@query(
    "log_pattern_samples",
    "WITH "
    + DL
    + """
SELECT regexp_replace(regexp_replace(line, '[0-9a-fA-F]{16,}', '<hex>', 'g'), '[0-9]+', '<num>', 'g') AS pattern,
       block, COUNT(*) AS n
FROM dl GROUP BY 1, 2
""",
)
def q_log_pattern_samples(spark: SparkSession, root: str) -> DataFrame:
    """L5 over time: lines of every pattern per time block."""
    return pattern_samples(doc_lines(spark, root), "line", "block")


@query(
    "series_sort",
    "WITH "
    + DL
    + """,
c AS (SELECT source, block, COUNT(*) AS n FROM dl GROUP BY 1, 2),
s AS (SELECT source, STDDEV_POP(n) AS sd, SUM(n) AS s, MAX(n) AS mx, MIN(n) AS mn,
             quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.9) AS p90 FROM c GROUP BY 1)
SELECT source, R6(sd) AS stddev, CAST(s AS BIGINT) AS "sum", mx AS "max", mn AS "min", R6(p50) AS p50, R6(p90) AS p90,
       CAST(row_number() OVER (ORDER BY sd DESC NULLS LAST, source) AS INTEGER) AS rank
FROM s
""",
)
def q_series_sort(spark: SparkSession, root: str) -> DataFrame:
    """Per-source line-count series ordered by standard deviation (desc), then name."""
    c = doc_lines(spark, root).groupBy("source", "block").agg(F.count(F.lit(1)).alias("n"))
    ranked = rank_series(series_stats(c, "source", "n"), "stddev", "source")
    return ranked.withColumns({k: rnd(k) for k in ["stddev", "p50", "p90"]})


@query(
    "series_outer_join",
    "WITH "
    + DL
    + """
SELECT block, NULLIF(COUNT(*) FILTER (WHERE level = 'de'), 0) AS de, NULLIF(COUNT(*) FILTER (WHERE level = 'en'), 0) AS en,
       NULLIF(COUNT(*) FILTER (WHERE level = 'es'), 0) AS es, NULLIF(COUNT(*) FILTER (WHERE level = 'fr'), 0) AS fr
FROM dl WHERE level IN ('de', 'en', 'es', 'fr') GROUP BY 1
""",
)
def q_series_outer_join(spark: SparkSession, root: str) -> DataFrame:
    """The line-count series of all languages joined on the union of their time points."""
    dl = doc_lines(spark, root)
    frames = {
        lang: dl.where(F.col("level") == lang).groupBy("block").agg(F.count(F.lit(1)).alias("n"))
        for lang in values_of(read_table(spark, root, "documents"), "lang")
    }
    return outer_join_series(frames, "block", "n")


@query(
    "line_filter",
    "WITH "
    + DL
    + r"""
SELECT doc_id, line_no, coalesce(level, '') || ' ' || coalesce(source, '') || ': ' || coalesce(line, '') AS formatted
FROM dl WHERE contains(line, '@') AND NOT regexp_matches(line, 'example\.org')
""",
)
def q_line_filter(spark: SparkSession, root: str) -> DataFrame:
    """Lines with an '@' but no 'example.org' match, rewritten by a template."""
    dl = line_filter(doc_lines(spark, root), contains=["@"], not_regex=[r"example\.org"])
    return dl.select("doc_id", "line_no", line_format("{{.level}} {{.source}}: {{.line}}").alias("formatted"))


@query(
    "log_bytes",
    "WITH " + DL + "\nSELECT block, level, CAST(SUM(strlen(line)) AS BIGINT) AS bytes FROM dl GROUP BY 1, 2",
)
def q_log_bytes(spark: SparkSession, root: str) -> DataFrame:
    """UTF-8 bytes of the lines per block and level."""
    return bytes_volume(doc_lines(spark, root), ["block", "level"])


PROFILE_SQL = "WITH " + FIELDS_SQL + """,
nl AS (SELECT doc_id, lang, source, len(string_split(text, chr(10))) AS w FROM documents WHERE text IS NOT NULL),
labels AS (
  SELECT 'level' AS key, event_type AS value, 1 AS w FROM events
  UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR), 1 FROM events
  UNION ALL SELECT 'level', lang, w FROM nl
  UNION ALL SELECT 'source', source, w FROM nl
),
tot AS (SELECT (SELECT COUNT(*) FROM events) + (SELECT SUM(w) FROM nl) AS total),
lp AS (
  SELECT 'label' AS kind, key, COUNT(DISTINCT value) AS n_values,
         CASE WHEN bool_and(TRY_CAST(value AS BIGINT) IS NOT NULL) THEN 'int'
              WHEN bool_and(TRY_CAST(value AS DOUBLE) IS NOT NULL) THEN 'float' ELSE 'string' END AS type,
         'label' AS parsers, CAST(SUM(w) AS BIGINT) AS n_lines
  FROM labels WHERE key IS NOT NULL GROUP BY key
),
fp AS (
  SELECT 'field' AS kind, key, COUNT(DISTINCT value) AS n_values,
         CASE WHEN bool_and(TRY_CAST(value AS BIGINT) IS NOT NULL) THEN 'int'
              WHEN bool_and(TRY_CAST(value AS DOUBLE) IS NOT NULL) THEN 'float' ELSE 'string' END AS type,
         array_to_string(list_sort(list_distinct(list(parser))), ',') AS parsers,
         COUNT(DISTINCT stream || '|' || line_id) AS n_lines
  FROM fields WHERE key IS NOT NULL GROUP BY key
)
SELECT kind, key, n_values, type, parsers, n_lines, R6(n_lines * 100.0 / (SELECT total FROM tot)) AS pct_lines
FROM (SELECT * FROM lp UNION ALL SELECT * FROM fp)
"""


@query("field_profile", PROFILE_SQL)
def q_field_profile(spark: SparkSession, root: str) -> DataFrame:
    """L10 + L11: detected labels (per labelled unit, weighted by its lines) and
    detected fields (per parsed line): distinct values, type, parsers, line share."""
    ev = read_table(spark, root, "events")
    docs = read_table(spark, root, "documents").where(F.col("text").isNotNull()).select(
        "lang", "source", F.size(F.split("text", "\n", -1)).alias("w")
    )
    one = F.lit(1).cast("bigint")

    def kv(pairs: list[tuple[str, str]], weight):
        # one scan per table, one output row per label
        return F.explode(
            F.array(*[F.struct(F.lit(k).alias("key"), F.col(c).cast("string").alias("value")) for k, c in pairs])
        ).alias("kv"), weight.alias("weight")

    labels = (
        ev.select(*kv([("level", "event_type"), ("user_id", "user_id")], one))
        .unionByName(docs.select(*kv([("level", "lang"), ("source", "source")], F.col("w").cast("bigint"))))
        .select("kv.key", "kv.value", "weight")
    )
    total = ev.select(one.alias("w")).unionByName(docs.select(F.col("w").cast("bigint"))).agg(F.sum("w"))
    fields = _all_fields(spark, root, nth=True)
    out = label_profile(labels, total).withColumn("kind", F.lit("label")).unionByName(
        field_profile(fields, ["stream", "line_id"], total).withColumn("kind", F.lit("field"))
    )
    return out.select("kind", "key", "n_values", "type", "parsers", "n_lines", rnd("pct_lines").alias("pct_lines"))


@query(
    "log_volume_rollup",
    f"""
SELECT {HOUR_SQL} AS bucket, event_type AS level,
       CAST(SUM(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS volume
FROM events GROUP BY 1, 2
""",
)
def q_log_volume_rollup(spark: SparkSession, root: str) -> DataFrame:
    """Rows carry a pre-aggregated count (``k``); roll up 10-minute sums to hours."""
    el = event_logs(spark, root).withColumn("count", F.get_json_object("line", "$.k").try_cast("int"))
    fine = el.groupBy(bucket_start(F.col("ts"), 600).alias("b10"), "level").agg(F.sum("count").alias("c"))
    return fine.groupBy(bucket_start(F.col("b10"), 3600).alias("bucket"), "level").agg(F.sum("c").alias("volume"))


TEMPLATE_RULE = {"min_lines": 5, "share": 0.002, "depth": 3}


def _merge_level(at: int) -> str:
    """Prefix-tree level ``at`` (from 0) of the templates, as a CTE over the level before."""
    return f"""
t{at + 1} AS (
  SELECT size, tokens, n, support,
         CASE WHEN SUM(n) OVER (PARTITION BY size, list_slice(template, 1, {at + 1})) < support AND size > {at}
              THEN list_concat(list_concat(list_slice(template, 1, {at}), ['<*>']), list_slice(template, {at + 2}, size))
              ELSE template END AS template
  FROM t{at})"""


@query(
    "log_templates",
    "WITH "
    + DL
    + f""",
m AS (SELECT *, regexp_replace(regexp_replace(line, '[0-9a-fA-F]{{16,}}', '<hex>', 'g'), '[0-9]+', '<num>', 'g') AS pattern
      FROM dl),
p AS (SELECT pattern, COUNT(*) AS n, string_split(pattern, ' ') AS words, len(string_split(pattern, ' ')) AS size
      FROM m GROUP BY pattern),
s AS (SELECT size, greatest({TEMPLATE_RULE["min_lines"]}, CAST(ceil(SUM(n) * {TEMPLATE_RULE["share"]}::DOUBLE) AS BIGINT)) AS support
      FROM p GROUP BY size),
w AS (SELECT pattern, size, n, generate_subscripts(words, 1) AS pos, unnest(words) AS word FROM p),
f AS (SELECT size, pos, word FROM w JOIN s USING (size) GROUP BY size, pos, word, support HAVING SUM(n) >= support),
a AS (SELECT w.pattern, w.size, w.n, list(CASE WHEN f.word IS NULL THEN '<*>' ELSE w.word END ORDER BY w.pos) AS tokens
      FROM w LEFT JOIN f ON f.size = w.size AND f.pos = w.pos AND f.word = w.word GROUP BY 1, 2, 3),
t0 AS (SELECT size, tokens, SUM(n) AS n, support, tokens AS template FROM a JOIN s USING (size) GROUP BY size, tokens, support),
"""
    + ",".join(_merge_level(at) for at in range(TEMPLATE_RULE["depth"]))
    + f""",
r AS (SELECT a.pattern, array_to_string(t.template, ' ') AS template
      FROM a JOIN t{TEMPLATE_RULE["depth"]} t ON t.size = a.size AND t.tokens = a.tokens)
SELECT r.template, COUNT(*) AS total, COUNT(DISTINCT block) AS n_buckets,
       array_to_string(list_sort(list_distinct(list(level))), ',') AS levels, COUNT(DISTINCT m.pattern) AS n_patterns
FROM m JOIN r ON r.pattern = m.pattern GROUP BY r.template
""",
)
def q_log_templates(spark: SparkSession, root: str) -> DataFrame:
    """Templates mined from all lines, with their lines, patterns, blocks and levels."""
    out = template_rollup(doc_lines(spark, root), "line", "block", "level", **TEMPLATE_RULE)
    return out.select("template", "total", "n_buckets", "levels", "n_patterns")


@query(
    "changepoint_sort",
    "WITH "
    + DL
    + """,
c AS (SELECT source, block, CAST(COUNT(*) AS BIGINT) AS v FROM dl GROUP BY 1, 2),
w AS (SELECT source, CAST(SUM(v) AS BIGINT) AS total, COUNT(*) AS n, STDDEV_POP(v) AS sd FROM c GROUP BY 1),
r AS (SELECT source, block, CAST(SUM(v) OVER o AS BIGINT) - v AS s_past, row_number() OVER o AS k
      FROM c WINDOW o AS (PARTITION BY source ORDER BY block)),
x AS (SELECT r.source, r.block, r.k, abs(s_past * n - total * (k - 1)) AS shift
      FROM r JOIN w ON w.source IS NOT DISTINCT FROM r.source WHERE k > 1
      QUALIFY row_number() OVER (PARTITION BY r.source ORDER BY abs(s_past * n - total * (k - 1)) DESC, k) = 1),
z AS (SELECT w.source, n, CASE WHEN sd > 0 THEN shift::DOUBLE / n / (sd * sqrt(n)) ELSE 0.0 END AS score,
             CASE WHEN sd > 0 THEN x.block END AS changed_at
      FROM w LEFT JOIN x ON w.source IS NOT DISTINCT FROM x.source)
SELECT source, n, R6(score) AS score, changed_at, CAST(row_number() OVER (ORDER BY score DESC NULLS LAST, source) AS INTEGER) AS rank
FROM z
""",
)
def q_changepoint_sort(spark: SparkSession, root: str) -> DataFrame:
    """Per-source line-count series, those whose mean shifts most first."""
    c = doc_lines(spark, root).groupBy("source", "block").agg(F.count(F.lit(1)).alias("n_lines"))
    found = change_points(c, "source", "block", "n_lines", F.expr("block div 16"))
    return rank_series(found, "score", "source").withColumn("score", rnd("score"))


@query(
    "field_cardinality",
    f"""
WITH f AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, key, json_extract_string(props, '$."' || key || '"') AS value
  FROM (SELECT ts, props, unnest(json_keys(props)) AS key FROM events)
  UNION ALL SELECT strftime(ts, '%Y-%m-%d'), 'user_id', CAST(user_id AS VARCHAR) FROM events
)
SELECT key, COUNT(*) AS n_fields, COUNT(DISTINCT day) AS n_days, COUNT(DISTINCT value) AS n_values, true AS within_bound
FROM f WHERE day >= '2024-01-05' AND day < '2024-01-20' GROUP BY key
""",
)
def q_field_cardinality(spark: SparkSession, root: str) -> DataFrame:
    """Distinct values of every field over a range of days, exactly, and whether the merged
    daily sketches agree within 5 % (about four standard errors)."""
    el = event_logs(spark, root).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    json = parsed_fields(el, ["day"]).select("day", "key", "value")
    fields = json.unionByName(el.select("day", F.lit("user_id").alias("key"), F.col("user_id").cast("string").alias("value")))
    stored = written(cardinality_sketches(fields, F.col("day")), "field-sketches")
    in_range = (F.col("day") >= "2024-01-05") & (F.col("day") < "2024-01-20")
    merged = merged_cardinality(stored.where(in_range)).withColumnRenamed("n_values", "estimate")
    exact = fields.where(in_range & F.col("key").isNotNull()).groupBy("key").agg(F.count_distinct("value").alias("n_values"))
    bound = F.abs(F.col("estimate") - F.col("n_values")) <= 0.05 * F.col("n_values")
    return merged.join(exact, "key").select("key", "n_fields", "n_days", "n_values", bound.alias("within_bound"))
