"""Roll-ups, monitoring, queues, states and sentences."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lumenframe.operators import monitor, rollup
from lumenframe.plans import query, table

_NOW = "2024-01-29 18:00:00"


@query("""WITH p AS (SELECT l_partkey, l_linenumber, CASE WHEN l_suppkey % 41 = 0 THEN NULL ELSE l_quantity::BIGINT * (p_size + 1) * (l_linenumber + 2) * CASE l_linenumber % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 8 END END AS b
FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_partkey AS partkey, CASE WHEN count_if(b IS NULL) = 0 THEN sum(b)::BIGINT END AS total_bytes, count_if(b IS NULL) AS missing FROM p GROUP BY l_partkey""")
def estimate_product(spark, sf):
    dtype = F.element_at(F.array(*[F.lit(x) for x in ("uint8", "uint16", "float32", "float64")]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    shape = F.when(F.col("l_suppkey") % 41 != 0, F.array((F.col("p_size") + 1).cast("long"), (F.col("l_linenumber") + 2).cast("long")))
    parts = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    parts = parts.select(F.col("l_partkey").alias("partkey"), F.col("l_quantity").cast("long").alias("files"), shape.alias("shape"), dtype.alias("dtype"))
    return rollup.estimate(parts, "partkey")


@query("""WITH f AS (SELECT page_id, regexp_replace(regexp_extract(url, '^[a-z0-9]+://([^?#]*)', 1), '/+$', '') AS path, CASE WHEN page_id % 10 > 0 THEN length(html) END AS size FROM pages),
s AS (SELECT *, string_split(path, '/') AS parts FROM f), d AS (SELECT *, parts[1:len(parts) - 1] AS dirs, lower(parts[len(parts)]) AS name FROM s),
l1 AS (SELECT regexp_replace(dirs[1], '\\d+', '#', 'g') AS form FROM (SELECT DISTINCT dirs FROM d) GROUP BY 1 HAVING count(DISTINCT dirs[1]) >= 3),
e AS (SELECT *, list_concat([CASE WHEN regexp_replace(dirs[1], '\\d+', '#', 'g') IN (SELECT form FROM l1) THEN regexp_replace(dirs[1], '\\d+', '#', 'g') ELSE dirs[1] END], dirs[2:]) AS c1 FROM d),
g AS (SELECT *, array_to_string(c1, '/') AS dir, CASE WHEN name LIKE '%.%' THEN string_split(name, '.')[len(string_split(name, '.'))] ELSE '(none)' END AS ext FROM e),
x AS (SELECT dir, ext, count(*) AS n FROM g GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY n DESC, ext) AS rank FROM x),
t AS (SELECT dir, string_agg('.' || ext || ' ' || n, ', ' ORDER BY rank) AS extensions FROM r WHERE rank <= 4 GROUP BY dir)
SELECT g.dir AS dir, count(*) AS n_files, sum(coalesce(size, 0))::BIGINT AS bytes, bool_or(size IS NULL) AS any_unknown, count(DISTINCT dirs) AS n_dirs, any_value(extensions) AS extensions FROM g JOIN t ON g.dir = t.dir GROUP BY g.dir""")
def dir_rollup(spark, sf):
    path = F.regexp_replace(F.regexp_extract("url", "^[a-z0-9]+://([^?#]*)", 1), "/+$", "")
    f = table(spark, sf, "pages").select(path.alias("path"), F.when(F.col("page_id") % 10 > 0, F.char_length("html").cast("long")).alias("size"))
    parts = F.split("path", "/")
    f = f.withColumn("dirs", F.slice(parts, 1, F.size(parts) - 1))
    return rollup.dir_stats(rollup.collapse_dirs(f, "dirs", 2))


@query("""WITH f AS (SELECT l_orderkey % 50 AS ds, l_quantity::BIGINT * 1000 AS size, l_discount < 0.09 AS complete, l_tax < 0.08 AS exact FROM lineitem)
SELECT count(*) AS n_files, sum(size)::BIGINT AS bytes, bool_and(complete) AS complete, bool_and(exact) AS exact, CASE WHEN count(*) > 0 AND bool_and(complete) AND bool_and(exact) THEN 'file-listing' ELSE 'estimated' END AS size_source FROM f""")
def listing_totals(spark, sf):
    f = table(spark, sf, "lineitem").select((F.col("l_quantity").cast("long") * 1000).alias("size"), (F.col("l_discount") < 0.09).alias("c"), (F.col("l_tax") < 0.08).alias("x"))
    return rollup.listing_totals(f, F.col("c"), F.col("x"))


@query("""WITH r AS (SELECT DISTINCT ts::DATE AS run FROM events), l AS (SELECT run FROM r ORDER BY run DESC LIMIT 5)
SELECT user_id, count(DISTINCT ts::DATE) AS n FROM events WHERE event_type = 'error' AND ts::DATE IN (SELECT run FROM l) GROUP BY user_id HAVING count(DISTINCT ts::DATE) >= 2""")
def recent_errors(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", F.to_date("ts").alias("run"))
    last = e.select("run").distinct().orderBy(F.desc("run")).limit(5)
    hits = e.where("event_type = 'error'").join(F.broadcast(last), "run", "left_semi")  # five rows
    return hits.groupBy("user_id").agg(F.count_distinct("run").alias("n")).where("n >= 2")


@query("""SELECT event_id, user_id, round(used, 2) AS used, used <= 2000 AS within FROM (SELECT event_id, user_id, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS used FROM events WHERE event_type = 'click')""")
def sampled_budget(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    e = table(spark, sf, "events").where("event_type = 'click'").withColumn("used", F.sum("value").over(w))
    return e.select("event_id", "user_id", F.round("used", 2).alias("used"), (F.col("used") <= 2000).alias("within"))


_CADENCE = [("view", 1, True), ("click", 24, True), ("purchase", 1, False), ("signup", 0, True), ("error", 1, True), ("export", 1, False)]


def _alerts(spark, sf, now):
    # a run: the events of a type in six hours; it failed if its mean is low and added what is high
    e = table(spark, sf, "events").where(F.col("ts") <= F.lit(now).cast("timestamp"))
    slot = F.floor(F.unix_timestamp("ts") / 21600)
    runs = e.groupBy(F.col("event_type").alias("routine"), slot.alias("slot")).agg(
        F.max("ts").alias("started_at"),
        F.when(F.min("value") < 2, "failed").otherwise("ok").alias("status"),
        F.count_if(F.col("value") > 120).alias("added"),
    )
    cadence = spark.createDataFrame(_CADENCE, "routine string, hours int, finds boolean")
    return monitor.alerts(runs, cadence, F.lit(now).cast("timestamp"))


def _alerts_sql(now: str) -> str:
    rows = ", ".join(f"('{r}', {h}, {str(f).lower()})" for r, h, f in _CADENCE)
    return f"""(WITH runs AS (SELECT event_type AS routine, floor(epoch(ts) / 21600) AS slot, max(ts) AS started_at, CASE WHEN min(value) < 2 THEN 'failed' ELSE 'ok' END AS status, count_if(value > 120) AS added
 FROM events WHERE ts <= TIMESTAMP '{now}' GROUP BY ALL), l AS (SELECT *, row_number() OVER (PARTITION BY routine ORDER BY started_at DESC) AS rn FROM runs),
s AS (SELECT routine, max(started_at) AS last, count(*) AS n, bool_and(status IN ('failed', 'running')) AS failing, bool_and(added = 0) AS dry FROM l WHERE rn <= 3 GROUP BY routine),
j AS (SELECT c.*, s.last, s.n, s.failing, s.dry FROM (VALUES {rows}) c(routine, hours, finds) LEFT JOIN s ON c.routine = s.routine)
SELECT routine || ':none' AS key FROM j WHERE last IS NULL UNION ALL SELECT routine || ':stale' FROM j WHERE epoch(TIMESTAMP '{now}' - last) / 3600 > 2 * hours + 2
UNION ALL SELECT routine || ':failing' FROM j WHERE n = 3 AND failing UNION ALL SELECT routine || ':dry' FROM j WHERE n = 3 AND finds AND dry AND NOT failing)"""


@query(f"SELECT key FROM {_alerts_sql(_NOW)}")
def watchdog_alerts(spark, sf):
    return _alerts(spark, sf, _NOW)


@query(f"""SELECT coalesce(a.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'raised' ELSE 'cleared' END AS change FROM {_alerts_sql('2024-02-02 00:00:00')} a FULL OUTER JOIN {_alerts_sql(_NOW)} b ON a.key = b.key WHERE a.key IS NULL OR b.key IS NULL""")
def alert_diff(spark, sf):
    return monitor.changed_keys(_alerts(spark, sf, _NOW), _alerts(spark, sf, "2024-02-02 00:00:00"))


@query("SELECT user_id, event_type, event_id, round(value) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_per_group(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", F.round("value").alias("value"))
    return monitor.upsert(e, "user_id", F.col("ts"), F.col("event_id")).select("user_id", "event_type", "event_id", "value")


@query("""WITH done AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01'), failed AS (SELECT l_partkey AS id FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING count(*) >= 15),
c AS (SELECT p_partkey AS id, CASE WHEN p_size % 5 > 0 THEN p_size::BIGINT * 1000000000 END AS size, p_retailprice::BIGINT * 10000000 AS whole FROM part)
SELECT id, size FROM c WHERE id NOT IN (SELECT id FROM done) AND id NOT IN (SELECT id FROM failed) AND coalesce(size, whole) <= 20 * 1024.0 ** 3 ORDER BY size IS NULL, coalesce(size, 0), id LIMIT 20""")
def queue_next(spark, sf):
    li = table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "id")
    c = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_size") % 5 > 0, F.col("p_size").cast("long") * 1000000000).alias("size"),
        (F.round("p_retailprice").cast("long") * 10000000).alias("whole_size"),
    )
    done = li.where(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp"))
    return monitor.queue(c, done, li.where("l_returnflag = 'R'"), 20 * 1024.0**3, 15).select("id", "size").limit(20)


@query("""SELECT c_custkey, last FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) ON c_custkey = o_custkey
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01') ORDER BY last NULLS FIRST, c_custkey LIMIT 10""")
def frontier_next(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    last = o.where("o_orderstatus <> 'P'").groupBy("c_custkey").agg(F.max("o_orderdate").alias("last"))
    running = o.where(F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp")).select("c_custkey").distinct()
    c = table(spark, sf, "customer").select("c_custkey").join(last, "c_custkey", "left").join(running, "c_custkey", "left_anti")
    return c.orderBy(F.asc_nulls_first("last"), "c_custkey").limit(10)


@query("""WITH o AS (SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50), u AS (SELECT o_orderkey, o_orderstatus, unnest(list_filter([CASE WHEN o_custkey % 3 > 0 THEN o_custkey END, o_orderkey % 1500], lambda x: x IS NOT NULL)) AS link FROM o)
SELECT o_orderkey, count(*) AS links, bool_and(c_acctbal > 0) AS ok FROM u JOIN customer ON link = c_custkey GROUP BY o_orderkey""")
def oldest_n_check(spark, sf):
    o = table(spark, sf, "orders").orderBy("o_orderdate", "o_orderkey").limit(50)
    links = F.filter(F.array(F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey")), F.col("o_orderkey") % 1500), lambda x: x.isNotNull())
    u = o.select("o_orderkey", F.explode(links).alias("c_custkey")).join(table(spark, sf, "customer"), "c_custkey")
    return u.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("links"), F.bool_and(F.col("c_acctbal") > 0).alias("ok"))


@query("""WITH s AS (SELECT doc_id, unnest(string_split_regex(regexp_replace(text, '([.;])[ \\t\\n\\x0b\\f\\r]+', '\\1' || chr(1), 'g'), '\\x01|\\n')) AS sent, generate_subscripts(string_split_regex(regexp_replace(text, '([.;])[ \\t\\n\\x0b\\f\\r]+', '\\1' || chr(1), 'g'), '\\x01|\\n'), 1) AS pos FROM documents),
k AS (SELECT *, regexp_matches(lower(sent), 'idiot|licen[cs]e|password') AS strong FROM s WHERE length(sent) > 20 AND length(sent) < 600 AND regexp_matches(sent, '[0-9]|the '))
SELECT doc_id, rank, md5(sent) AS digest, strong FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY NOT strong, pos) AS rank FROM k) WHERE rank <= 60""")
def key_sentences(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", r"(?<=[.;])\s+|\n")).alias("pos", "sent"))
    d = d.where((F.char_length("sent") > 20) & (F.char_length("sent") < 600) & F.col("sent").rlike("[0-9]|the "))
    d = d.withColumn("strong", F.lower("sent").rlike("idiot|licen[cs]e|password"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(~F.col("strong"), "pos"))
    return d.withColumn("rank", rank).where("rank <= 60").select("doc_id", "rank", F.md5("sent").alias("digest"), "strong")


@query("SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'the') AND contains(lower(text), 'tion') AND contains(lower(source || ' ' || text), 'src1') ORDER BY doc_id LIMIT 25")
def idr_terms(spark, sf):
    terms = F.split(F.lit("the tion src1"), " ")
    full = F.lower(F.concat_ws(" ", "source", "text"))
    d = table(spark, sf, "documents").where(F.forall(terms, lambda t: F.contains(full, t)))
    return d.orderBy("doc_id").limit(25).select("doc_id", "lang")


@query("""WITH e AS (SELECT user_id AS id, event_id AS seq, CASE event_type WHEN 'purchase' THEN CASE WHEN event_id % 5 = 0 THEN 'downloaded' END WHEN 'error' THEN 'failed' WHEN 'signup' THEN CASE WHEN event_id % 9 = 0 THEN 'skipped' END END AS kind, 'l' || (event_id % 3) AS label FROM events),
f AS (SELECT * FROM e WHERE kind IS NOT NULL), d AS (SELECT id, max(seq) AS done_at, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM f WHERE kind = 'downloaded' GROUP BY id)
SELECT f.id AS id, CASE WHEN max(done_at) IS NOT NULL THEN 'downloaded' WHEN bool_or(kind = 'skipped') THEN 'skipped' WHEN count_if(kind = 'failed') > 0 THEN 'failed' ELSE 'new' END AS status,
count_if(kind = 'failed' AND (done_at IS NULL OR seq > done_at)) AS n_failures, coalesce(any_value(labels), '') AS labels FROM f LEFT JOIN d ON f.id = d.id GROUP BY f.id""")
def state_upsert(spark, sf):
    k, t = F.col("event_id"), F.col("event_type")
    kind = F.when((t == "purchase") & (k % 5 == 0), "downloaded").when(t == "error", "failed").when((t == "signup") & (k % 9 == 0), "skipped")
    e = table(spark, sf, "events").select(F.col("user_id").alias("id"), k.alias("seq"), kind.alias("kind"), F.concat(F.lit("l"), (k % 3).cast("string")).alias("label"))
    return monitor.final_state(e.where("kind is not null"))


@query("""WITH r AS (SELECT user_id, ts::DATE AS day, count_if(event_type = 'signup') AS added, count_if(event_type = 'purchase') AS enriched, count_if(event_type = 'error') AS errors, epoch(max(ts) - min(ts)) / 60 AS minutes FROM events GROUP BY ALL)
SELECT user_id, day, CASE WHEN errors > 0 AND added + enriched = 0 THEN 'failed' WHEN errors > 0 THEN 'partial' ELSE 'ok' END AS status, CASE WHEN added >= 1 THEN 'found' WHEN minutes >= 110 THEN 'time-limit' ELSE 'frontier-exhausted' END AS stop_reason FROM r""")
def run_status(spark, sf):
    t = F.col("event_type")
    r = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count_if(t == "signup").alias("added"), F.count_if(t == "purchase").alias("enriched"), F.count_if(t == "error").alias("errors"),
        ((F.max("ts").cast("timestamp").cast("double") - F.min("ts").cast("timestamp").cast("double")) / 60).alias("minutes"),
    )
    status, stop = monitor.run_status(F.col("added"), F.col("enriched"), F.col("errors"), F.col("minutes"), 1)
    return r.select("user_id", "day", status.alias("status"), stop.alias("stop_reason"))
