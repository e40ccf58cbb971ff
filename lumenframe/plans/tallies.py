"""Counts, labels, rules and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import rules, text
from lumenframe.operators import tally as op
from lumenframe.plans import query, table


@query("""SELECT value, count(*) AS n FROM (
  SELECT unnest(CASE WHEN p_size % 10 = 0 THEN ['(none)'] ELSE string_split(p_name, ' ') END) AS value FROM part) GROUP BY value""")
def tally_category(spark, sf):
    words = F.when(F.col("p_size") % 10 != 0, F.split("p_name", " "))
    return op.tally(table(spark, sf, "part"), words)


@query("""SELECT r_name AS dim, coalesce(grp, '(none)') AS grp, coalesce(n, 0) AS n FROM region LEFT JOIN (
  SELECT n_regionkey, CASE WHEN c_acctbal < 0 THEN '(not stated)' ELSE c_mktsegment END AS grp, count(*) AS n
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 4 GROUP BY ALL) ON r_regionkey = n_regionkey""")
def tally_by_dim(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.where("n_regionkey <> 4").withColumnRenamed("n_regionkey", "r_regionkey")
    group = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    out = op.by_level(c, table(spark, sf, "region").select("r_regionkey"), "r_regionkey", group)
    return out.join(table(spark, sf, "region"), "r_regionkey").select(F.col("r_name").alias("dim"), "grp", "n")


@query("""WITH c AS (SELECT value, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part) GROUP BY value),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, value) AS rank, (SELECT count(*) FROM c) AS total FROM c)
SELECT CASE WHEN total > 5 AND rank >= 5 THEN '+ ' || (total - 4) || ' more' ELSE value END AS value, sum(n)::BIGINT AS n,
count(*) AS members FROM r GROUP BY 1""")
def topk_folded(spark, sf):
    return op.folded_top(op.tally(table(spark, sf, "part"), F.split("p_name", " ")), 5)


@query("""SELECT count(*) AS n, count_if(event_type = 'error') AS errors, count_if(value > 100) AS large,
count_if(ts >= TIMESTAMP '2024-01-29 12:00:00') AS recent, round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 2) AS bought,
round(sum(CASE WHEN ts >= TIMESTAMP '2024-01-29 12:00:00' AND event_type = 'error' THEN value ELSE 0 END), 2) AS failed_recent FROM events""")
def tiles_conditional(spark, sf):
    recent = F.col("ts") >= F.lit("2024-01-29 12:00:00").cast("timestamp")
    return table(spark, sf, "events").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.count_if(F.col("value") > 100).alias("large"),
        F.count_if(recent).alias("recent"),
        F.round(F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)), 2).alias("bought"),
        F.round(F.sum(F.when(recent & (F.col("event_type") == "error"), F.col("value")).otherwise(0.0)), 2).alias("failed_recent"),
    )


@query("""SELECT d::DATE AS day, coalesce(n, 0) AS n FROM generate_series(DATE '2023-12-25', DATE '2024-01-23', INTERVAL 1 DAY) s(d)
LEFT JOIN (SELECT ts::DATE AS day, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY 1) e ON e.day = d::DATE""")
def daily_zero_fill(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'signup'")
    return op.daily(e, F.col("ts"), "2023-12-25", "2024-01-23")


@query("""WITH r AS (SELECT o_orderkey, list_filter([
  CASE WHEN o_totalprice > 400000 THEN 'array ' || (o_orderkey % 7) || ' is large; price ' || o_custkey END,
  CASE WHEN o_orderstatus = 'F' THEN 'order closed: https://x/' || o_orderkey END,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END], lambda x: x IS NOT NULL) AS reasons FROM orders),
u AS (SELECT DISTINCT o_orderkey, substr(string_split(string_split(regexp_replace(unnest(reasons), 'array \\d+', 'array', 'g'), ';')[1], ': http')[1], 1, 100) AS reason FROM r)
SELECT reason, count(*) AS n, min(o_orderkey) AS first_key FROM u GROUP BY reason""")
def reason_tally(spark, sf):
    found = rules.reasons(
        (F.col("o_totalprice") > 400000, F.concat(F.lit("array "), (F.col("o_orderkey") % 7).cast("string"), F.lit(" is large; price "), F.col("o_custkey").cast("string"))),
        (F.col("o_orderstatus") == "F", F.concat(F.lit("order closed: https://x/"), F.col("o_orderkey").cast("string"))),
        (F.col("o_orderpriority") == "1-URGENT", "urgent"),
    )
    short = F.transform(found, lambda r: F.substring(F.substring_index(F.substring_index(F.regexp_replace(r, r"array \d+", "array"), ";", 1), ": http", 1), 1, 100))
    o = table(spark, sf, "orders").select("o_orderkey", F.explode(F.array_distinct(short)).alias("reason"))
    return o.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"))


@query("""SELECT o_orderkey, CASE WHEN n IS NULL THEN 'unknown' WHEN n < 1000000000 THEN '<1GB' WHEN n < 10000000000 THEN '1-10GB'
WHEN n < 50000000000 THEN '10-50GB' WHEN n < 500000000000 THEN '50-500GB' ELSE '>500GB' END AS bucket,
CASE WHEN n IS NULL THEN 'unknown' WHEN n < 1000 THEN printf('%.0f B', n::DOUBLE) WHEN n / 1e3 < 1000 THEN printf('%.1f KB', n / 1e3)
WHEN n / 1e6 < 1000 THEN printf('%.1f MB', n / 1e6) WHEN n / 1e9 < 1000 THEN printf('%.1f GB', n / 1e9) ELSE printf('%.1f TB', n / 1e12) END AS human
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE (floor(o_totalprice) * floor(o_totalprice))::BIGINT * (1 + o_orderkey % 5) END AS n FROM orders)""")
def size_bucket(spark, sf):
    whole = F.floor("o_totalprice").cast("long")
    n = F.when(F.col("o_orderkey") % 11 != 0, whole * whole * (1 + F.col("o_orderkey") % 5))
    o = table(spark, sf, "orders").select("o_orderkey", n.alias("n"))
    return o.select("o_orderkey", text.size_bucket(F.col("n")).alias("bucket"), text.human_size(F.col("n")).alias("human"))


@query("""SELECT p_partkey, array_to_string(labels, '|') AS labels FROM (SELECT p_partkey, list_filter(list_distinct_ordered, lambda x: x IS NOT NULL) AS labels FROM (
  SELECT p_partkey, list_transform(list_filter(list_transform(generate_series(1, len(l)), lambda i: CASE WHEN list_position(l, l[i]) = i THEN l[i] END), lambda x: x IS NOT NULL), lambda x: x) AS list_distinct_ordered FROM (
    SELECT p_partkey, list_filter(list_concat(['dim:' || p_type], list_transform(string_split(p_name, ' ')[1:4], lambda w: rtrim(substr('org:' || w, 1, 50))),
      [rtrim(substr('fmt:' || repeat(p_brand || ' ', 7), 1, 50)), CASE WHEN p_size > 40 THEN 'size:large' END, 'dim:' || p_type]), lambda x: x IS NOT NULL) AS l FROM part)))""")
def label_array(spark, sf):
    labels = rules.ordered_distinct(
        F.array(text.label("dim:", F.col("p_type"))),
        F.transform(F.slice(F.split("p_name", " "), 1, 4), lambda w: text.label("org:", w)),
        F.array(text.label("fmt:", F.repeat(F.concat("p_brand", F.lit(" ")), 7)), F.when(F.col("p_size") > 40, "size:large"), text.label("dim:", F.col("p_type"))),
    )
    return table(spark, sf, "part").select("p_partkey", F.array_join(labels, "|").alias("labels"))


_MANAGED = "^(dim:|size:|flag$)"


@query("""WITH h AS (SELECT l_partkey, list_sort(list_distinct(list_concat(list('dim:' || l_returnflag), list('own:' || l_linestatus)))) AS have FROM lineitem GROUP BY l_partkey),
w AS (SELECT p_partkey, list_distinct(['dim:' || substr(p_type, 1, 1), 'dim:R', CASE WHEN p_size > 25 THEN 'size:big' ELSE 'size:small' END]) AS want, coalesce(have, []) AS have FROM part LEFT JOIN h ON p_partkey = l_partkey)
SELECT p_partkey, array_to_string(list_sort(list_filter(want, lambda x: NOT list_contains(have, x))), '|') AS to_add,
array_to_string(list_sort(list_filter(have, lambda x: NOT list_contains(want, x) AND regexp_matches(x, '^(dim:|size:|flag$)'))), '|') AS to_remove FROM w""")
def label_diff(spark, sf):
    have = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.concat(F.collect_set(F.concat(F.lit("dim:"), "l_returnflag")), F.collect_set(F.concat(F.lit("own:"), "l_linestatus"))).alias("have")
    )
    want = F.array_distinct(F.array(F.concat(F.lit("dim:"), F.substring("p_type", 1, 1)), F.lit("dim:R"), F.when(F.col("p_size") > 25, "size:big").otherwise("size:small")))
    p = table(spark, sf, "part").join(have, "p_partkey", "left").select("p_partkey", want.alias("want"), F.coalesce("have", F.array().cast("array<string>")).alias("have"))
    gone = F.filter(F.array_except("have", "want"), lambda x: x.rlike(_MANAGED))
    return p.select("p_partkey", F.array_join(F.array_sort(F.array_except("want", "have")), "|").alias("to_add"), F.array_join(F.array_sort(gone), "|").alias("to_remove"))


@query("""WITH l AS (SELECT o_orderkey, list_filter([CASE WHEN o_orderkey % 3 > 0 THEN 'enriched' END, 'dim:' || o_orderstatus,
  'license:' || CASE WHEN o_custkey % 9 = 0 THEN 'unknown' ELSE c_mktsegment END, CASE WHEN o_orderkey % 13 = 0 THEN 'fmt:other' WHEN o_orderkey % 17 > 0 THEN 'fmt:tiff' END], lambda x: x IS NOT NULL) AS labels,
  o_orderpriority = '5-LOW' AS draft, CASE WHEN o_orderkey % 19 = 0 THEN ['hold', 'do-not-merge'] WHEN o_orderkey % 23 = 0 THEN ['hold'] ELSE [] END AS held
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, array_to_string(list_filter([
  CASE WHEN NOT list_contains(labels, 'enriched') THEN 'missing `enriched`' END,
  CASE WHEN NOT list_has_any(labels, ['dim:O', 'dim:F']) THEN 'dimensionality not allowed' END,
  CASE WHEN list_contains(labels, 'license:unknown') THEN 'license unknown' END,
  CASE WHEN len(list_filter(labels, lambda x: starts_with(x, 'fmt:'))) = 0 THEN 'no data format' WHEN list_contains(labels, 'fmt:other') THEN 'a data format is `other` (unknown)' END,
  CASE WHEN draft THEN 'draft' END, CASE WHEN len(held) > 0 THEN 'on hold (' || array_to_string(list_sort(held), ', ') || ')' END], lambda x: x IS NOT NULL), '; ') AS fails,
 list_contains(labels, 'enriched') AND list_has_any(labels, ['dim:O', 'dim:F']) AND NOT list_contains(labels, 'license:unknown') AND list_contains(labels, 'fmt:tiff') AND NOT draft AND len(held) = 0 AS passes FROM l""")
def policy_gate(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    k = F.col("o_orderkey")
    o = o.select(
        "o_orderkey",
        rules.ordered_distinct(F.array(
            F.when(k % 3 > 0, "enriched"), F.concat(F.lit("dim:"), "o_orderstatus"),
            F.concat(F.lit("license:"), F.when(F.col("o_custkey") % 9 == 0, "unknown").otherwise(F.col("c_mktsegment"))),
            F.when(k % 13 == 0, "fmt:other").when(k % 17 > 0, "fmt:tiff"),
        )).alias("labels"),
        (F.col("o_orderpriority") == "5-LOW").alias("draft"),
        F.when(k % 19 == 0, F.array(F.lit("hold"), F.lit("do-not-merge"))).when(k % 23 == 0, F.array(F.lit("hold"))).otherwise(F.array().cast("array<string>")).alias("held"),
    )
    formats = F.filter("labels", lambda x: F.startswith(x, F.lit("fmt:")))
    fails = rules.reasons(
        (~F.array_contains("labels", "enriched"), "missing `enriched`"),
        (~F.arrays_overlap("labels", F.array(F.lit("dim:O"), F.lit("dim:F"))), "dimensionality not allowed"),
        (F.array_contains("labels", "license:unknown"), "license unknown"),
        (F.size(formats) == 0, "no data format"),
        (F.array_contains("labels", "fmt:other"), "a data format is `other` (unknown)"),
        (F.col("draft"), "draft"),
        (F.size("held") > 0, F.concat(F.lit("on hold ("), F.array_join(F.array_sort("held"), ", "), F.lit(")"))),
    )
    return o.select("o_orderkey", F.array_join(fails, "; ").alias("fails"), (F.size(fails) == 0).alias("passes"))


@query("""WITH s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'registration' ELSE 'open' END AS access, CASE n_regionkey WHEN 0 THEN '2D' WHEN 1 THEN '3D+t' ELSE '3D' END AS dim,
  CASE WHEN s_acctbal > 0 THEN s_acctbal END AS voxel, CASE WHEN s_suppkey % 4 = 0 THEN NULL WHEN s_suppkey % 4 = 1 THEN 'no raw' ELSE '' END AS planned FROM supplier JOIN nation ON s_nationkey = n_nationkey),
r AS (SELECT *, list_filter([CASE WHEN access <> 'open' THEN 'access ' || access || ': needs open access' END,
  CASE WHEN dim <> '3D' THEN 'dimensionality ' || dim END, CASE WHEN voxel IS NULL THEN 'voxel size missing' END], lambda x: x IS NOT NULL) AS base FROM s)
SELECT s_suppkey, CASE WHEN starts_with(dim, '2D') THEN 'not-ready' WHEN planned IS NULL THEN CASE WHEN len(base) > 0 THEN 'not-ready' ELSE 'unknown' END
  WHEN len(base) > 0 OR planned <> '' THEN 'not-ready' ELSE 'ready' END AS status,
 array_to_string(CASE WHEN starts_with(dim, '2D') THEN base WHEN planned IS NULL THEN list_concat(base, ['planner not available']) WHEN planned <> '' THEN list_concat(base, [planned])
  WHEN len(base) > 0 THEN base ELSE ['note: raw only'] END, '; ') AS reasons FROM r""")
def readiness_rules(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey")
    s = s.select(
        "s_suppkey",
        F.when(k % 5 == 0, "registration").otherwise("open").alias("access"),
        F.when(F.col("n_regionkey") == 0, "2D").when(F.col("n_regionkey") == 1, "3D+t").otherwise("3D").alias("dim"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("voxel"),
        F.when(k % 4 == 1, "no raw").when(k % 4 > 1, "").alias("planned"),
    )
    base = rules.reasons(
        (F.col("access") != "open", F.concat(F.lit("access "), "access", F.lit(": needs open access"))),
        (F.col("dim") != "3D", F.concat(F.lit("dimensionality "), "dim")),
        (F.col("voxel").isNull(), "voxel size missing"),
    )
    flat = F.startswith("dim", F.lit("2D"))
    more = (
        F.when(flat, base)
        .when(F.col("planned").isNull(), F.concat(base, F.array(F.lit("planner not available"))))
        .when(F.col("planned") != "", F.concat(base, F.array("planned")))
        .when(F.size(base) > 0, base)
        .otherwise(F.array(F.lit("note: raw only")))
    )
    status = (
        F.when(flat, "not-ready")
        .when(F.col("planned").isNull() & (F.size(base) == 0), "unknown")
        .when(F.size(rules.blocking(more)) > 0, "not-ready")
        .otherwise("ready")
    )
    return s.select("s_suppkey", status.alias("status"), F.array_join(more, "; ").alias("reasons"))


@query("""SELECT c_custkey, array_to_string(list_filter([
 CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'c_mktsegment: ' || c_mktsegment || ' is not one of the values' END,
 CASE WHEN NOT regexp_matches(c_name, '^Customer#0+[1-9]') THEN 'c_name: does not match ^Customer#0+[1-9]' END,
 CASE WHEN c_acctbal < 0 THEN 'c_acctbal: is less than the minimum of 0' END,
 CASE WHEN c_acctbal > 9000 THEN 'c_acctbal: is greater than the maximum of 9000' END,
 CASE WHEN len(string_split(c_name, '#')) < 3 THEN 'parts: has too few items' END], lambda x: x IS NOT NULL), '; ') AS errors FROM customer""")
def record_schema_check(spark, sf):
    schema = {
        "c_mktsegment": {"enum": ["BUILDING", "MACHINERY", "FURNITURE"]},
        "c_name": {"pattern": "^Customer#0+[1-9]"},
        "c_acctbal": {"minimum": 0, "maximum": 9000},
        "parts": {"minItems": 3},
    }
    c = table(spark, sf, "customer").withColumn("parts", F.split("c_name", "#"))
    faults = rules.reasons(*rules.schema_rules(schema, ["c_custkey"]))
    return c.select("c_custkey", F.array_join(faults, "; ").alias("errors"))


@query("""SELECT d.doc_id AS doc_id, array_to_string(list_filter([
 CASE WHEN quality IS NOT NULL AND n_chars < 200 THEN 'method sample needs text' END,
 CASE WHEN toxic = 1 AND lang <> 'en' THEN 'value range needs method sample' END,
 CASE WHEN source = 'src0' AND quality IS NULL THEN 'size source needs a listing' END], lambda x: x IS NOT NULL), '; ') AS errors
FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id""")
def technical_consistency(spark, sf):
    marks = table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source").join(marks, "doc_id", "left")
    errors = rules.reasons(
        (F.col("quality").isNotNull() & (F.col("n_chars") < 200), "method sample needs text"),
        ((F.col("toxic") == 1) & (F.col("lang") != "en"), "value range needs method sample"),
        ((F.col("source") == "src0") & F.col("quality").isNull(), "size source needs a listing"),
    )
    return d.select("doc_id", F.array_join(errors, "; ").alias("errors"))


@query("""WITH caps AS (SELECT * FROM (VALUES ('de', 0.5), ('fr', 0.7), ('en', 0.85)) v(lang, cap)),
m AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id)
SELECT d.doc_id AS doc_id, printf('confidence %.2f over cap %.2f', (d.doc_id % 100) / 100.0, cap) AS message
FROM documents d JOIN caps ON d.lang = caps.lang JOIN m ON d.doc_id = m.doc_id WHERE (d.doc_id % 100) / 100.0 > cap""")
def confidence_caps(spark, sf):
    caps = spark.createDataFrame([("de", 0.5), ("fr", 0.7), ("en", 0.85)], "lang string, cap double")
    d = table(spark, sf, "documents").select("doc_id", "lang", ((F.col("doc_id") % 100) / 100.0).alias("confidence"))
    d = d.join(F.broadcast(caps), "lang").where("confidence > cap").join(table(spark, sf, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return d.select("doc_id", F.format_string("confidence %.2f over cap %.2f", "confidence", "cap").alias("message"))
