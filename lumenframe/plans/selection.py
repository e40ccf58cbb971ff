"""Selection specs, headers, reports and the extensions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lumenframe import streaming
from lumenframe.operators import select
from lumenframe.plans import query, table

SPEC = {"flag": {"in": ["A", "R"]}, "quantity": {"range": [5, 30]}, "type": {"in": ["PROMO", "ECONOMY"]}, "words": {"contains": "ring"}, "price": {"min": 905.0}, "brand": "any"}


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag IN ('A', 'R') AND l_quantity BETWEEN 5 AND 30 AND p_type IN ('PROMO', 'ECONOMY')
AND list_contains(string_split(p_name, ' '), 'ring') AND p_retailprice >= 905 AND regexp_matches('datasets/' || p_type || '/' || p_brand || '.yaml', '^datasets/.*/Brand#1[^/]*[.]yaml$') AND p_partkey NOT IN (7, 70, 700)""")
def spec_filter(spark, sf):
    p = table(spark, sf, "part").withColumn("p_words", F.split("p_name", " "))
    where = select.compiled(
        SPEC, {"flag": "l_returnflag", "quantity": "l_quantity", "type": "p_type", "words": "p_words:array", "price": "p_retailprice", "brand": "p_brand"}
    )
    path = F.concat(F.lit("datasets/"), "p_type", F.lit("/"), "p_brand", F.lit(".yaml"))
    p = p.where(select.glob_any(path, ["datasets/**/Brand#1*.yaml"]) & ~F.col("p_partkey").isin(7, 70, 700))
    return table(spark, sf, "lineitem").join(p, F.col("l_partkey") == F.col("p_partkey")).where(where).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""WITH d AS (SELECT doc_id, md5(text) AS content_hash, CASE WHEN doc_id % 3 = 0 THEN 'doi' || (n_chars % 97) END AS doi FROM documents),
a AS (SELECT * FROM d WHERE doc_id IN (SELECT min(doc_id) FROM d GROUP BY content_hash)) SELECT doc_id, doi FROM a WHERE doi IS NULL OR doc_id IN (SELECT min(doc_id) FROM a WHERE doi IS NOT NULL GROUP BY doi)""")
def spec_dedup(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("content_hash"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("doi"), (F.col("n_chars") % 97).cast("string"))).alias("doi"))
    return select.keep_first(d, ["content_hash", "doi"], "doc_id").select("doc_id", "doi")


@query("""WITH b AS (SELECT p_type, p_brand, sum(p_size) AS n FROM part GROUP BY ALL), t AS (SELECT p_type, sqrt(sum(n)) AS p FROM b GROUP BY 1)
SELECT p_type, p_brand, round(p / (SELECT sum(p) FROM t) * sqrt(n) / sum(sqrt(n)) OVER (PARTITION BY b.p_type), 8) AS weight FROM b JOIN t USING (p_type)""")
def spec_weights(spark, sf):
    w = select.weights(table(spark, sf, "part"), ["p_type", "p_brand"], "p_size", 0.5)
    return w.withColumn("weight", F.round("weight", 8))


_HASH = "((doc_id * 2654435761 + 12345) % 4294967296)"


@query(f"""SELECT doc_id, lang, CASE WHEN held THEN 'holdout' WHEN share < 0.8 THEN 'train' WHEN share < 0.9 THEN 'val' ELSE 'test' END AS split FROM (
 SELECT doc_id, lang, source = 'src7' AS held, (row_number() OVER (PARTITION BY lang, source = 'src7' ORDER BY {_HASH}, doc_id) - 1) / (count(*) OVER (PARTITION BY lang, source = 'src7'))::DOUBLE AS share FROM documents)""")
def spec_split(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source")
    order = (F.col("doc_id") * F.lit(2654435761) + F.lit(12345)) % F.lit(4294967296)
    out = select.split(d, "doc_id", ["lang"], order, {"train": 0.8, "val": 0.1, "test": 0.1}, F.col("source") == "src7")
    return out.select("doc_id", "lang", "split")


_V = "(SELECT vec_id AS crop, label, i, embedding[i + 1]::DOUBLE AS v FROM embeddings, generate_series(0, 63) g(i))"


@query(f"""WITH p AS (SELECT crop, quantile_cont(v, 0.01) AS a, quantile_cont(v, 0.99) - quantile_cont(v, 0.01) AS b FROM {_V} GROUP BY crop), z AS (SELECT label, avg(v) AS a, stddev_pop(v) AS b FROM {_V} GROUP BY label), m AS (SELECT crop, min(v) AS a, max(v) - min(v) AS b FROM {_V} GROUP BY crop)
SELECT v.crop AS crop, round(sum(least(greatest((v - p.a) / p.b, 0), 1) * (i + 1)), 3) AS by_percentile, round(sum((v - z.a) / z.b * (i + 1)), 3) AS by_zscore, round(sum((v - m.a) / m.b * (i + 1)), 3) AS by_minmax
FROM {_V} v JOIN p ON v.crop = p.crop JOIN z ON v.label = z.label JOIN m ON v.crop = m.crop GROUP BY v.crop""")
def spec_normalize(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("crop"), "label", F.posexplode("embedding").alias("i", "v")).withColumn("v", F.col("v").cast("double"))
    out = None
    for scope, method in (("crop", "percentile"), ("label", "zscore"), ("crop", "minmax")):
        part = select.normalized(e, scope, method).groupBy("crop").agg(F.round(F.sum(F.col("v") * (F.col("i") + 1)), 3).alias(f"by_{method}"))
        out = part if out is None else out.join(part, "crop")
    return out


@query("""SELECT p_partkey, count(*) AS n, max(z0) AS last_z, max(x0) AS last_x FROM (SELECT p_partkey, unnest(generate_series(0, greatest(ceil(p_size / 32.0)::INT - 1, 0))) * 32 AS z0, x0 FROM (
 SELECT p_partkey, p_size, unnest(generate_series(0, greatest(ceil(p_size * 20 / 256.0)::INT - 1, 0))) * 256 AS x0 FROM part)) GROUP BY p_partkey""")
def spec_patches(spark, sf):
    p = select.patches(table(spark, sf, "part"), "p_partkey", {"z": F.col("p_size"), "x": F.col("p_size") * 20}, {"z": 32, "x": 256})
    return p.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n"), F.max("z0").alias("last_z"), F.max("x0").alias("last_x"))


@query("""SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k, props::JSON ->> '$.missing' AS missing, CASE WHEN (props::JSON ->> '$.k')::BIGINT % 2 = 0 THEN 'uint16' ELSE 'float32' END AS dtype FROM events""")
def json_header(spark, sf):
    j = F.from_json("props", "k bigint, missing string")
    e = table(spark, sf, "events").select("event_id", j.alias("j"))
    return e.select("event_id", F.col("j.k").alias("k"), F.col("j.missing").alias("missing"), F.when(F.col("j.k") % 2 == 0, "uint16").otherwise("float32").alias("dtype"))


@query("""SELECT o_orderkey, '| ' || o_orderkey || ' | ' || replace(coalesce(CASE WHEN o_custkey % 5 > 0 THEN c_name || '|' || c_mktsegment END, 'unknown'), '|', '\\|') || ' | ' || coalesce(array_to_string(CASE WHEN o_orderkey % 4 > 0 THEN [o_orderstatus, substr(o_orderpriority, 1, 1)] END, ' x '), 'unknown') || ' |' AS line
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def report_text(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    cell = lambda c: F.replace(F.coalesce(c, F.lit("unknown")), F.lit("|"), F.lit("\\|"))
    name = F.when(F.col("o_custkey") % 5 > 0, F.concat("c_name", F.lit("|"), "c_mktsegment"))
    shape = F.when(F.col("o_orderkey") % 4 > 0, F.array_join(F.array("o_orderstatus", F.substring("o_orderpriority", 1, 1)), " x "))
    line = F.concat(F.lit("| "), F.col("o_orderkey").cast("string"), F.lit(" | "), cell(name), F.lit(" | "), F.coalesce(shape, F.lit("unknown")), F.lit(" |"))
    return o.select("o_orderkey", line.alias("line"))


@query("""SELECT 6 * 3600 * (floor(epoch(ts))::BIGINT // 21600) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL""")
def ext_streaming(spark, sf):
    """Extension: six-hour windows of a file stream, drained into a table."""
    schema = table(spark, sf, "events").schema
    e = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    e = e.withColumn("ts", F.col("ts").cast("timestamp"))
    got = streaming.drained(spark, streaming.windowed(e))
    return got.select(F.unix_timestamp("start").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT user_id, floor(epoch(min(ts)))::BIGINT AS start, count(*) AS n FROM n GROUP BY user_id, k""")
def ext_sessions(spark, sf):
    """Extension: sessions parted by six hours."""
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return streaming.sessions(e, "6 hours").select("user_id", F.unix_timestamp("start").alias("start"), "n")


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity)::BIGINT AS qty, count(*) AS n, grouping(l_returnflag, l_linestatus) AS level FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def ext_grouping_sets(spark, sf):
    """Extension: all levels of two columns in one pass."""
    c = table(spark, sf, "lineitem").cube("l_returnflag", "l_linestatus")
    return c.agg(F.sum("l_quantity").cast("long").alias("qty"), F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


@query("""SELECT p.event_id AS event_id, v.event_id AS before FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def ext_asof(spark, sf):
    """Extension: the last view of the same user before each purchase, one window over both."""
    e = table(spark, sf, "events").where("event_type in ('purchase', 'view')")
    view = F.when(F.col("event_type") == "view", F.col("event_id"))
    w = Window.partitionBy("user_id").orderBy("ts", F.col("event_type").desc())
    e = e.withColumn("before", F.last(view, True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return e.where("event_type = 'purchase'").select("event_id", "before")


@query()
def ext_approx(spark, sf):
    """Extension: approximate distinct counts and quantiles."""
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey").alias("parts"), F.percentile_approx("l_extendedprice", 0.5).alias("median"))
