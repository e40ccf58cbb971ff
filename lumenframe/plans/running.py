"""Plans, runs, versions and places of records, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import planning
from lumenframe.plans import query, table
from lumenframe.sources import storage, versions


@query("""WITH o AS (SELECT o_orderkey AS id, 'd' || (o_custkey % 40) AS dataset, o_orderstatus = 'P' AS halted, o_orderkey % 4 = 0 AS mask, o_orderkey % 5 AS g FROM orders),
c AS (SELECT *, CASE g WHEN 0 THEN 'cell' WHEN 1 THEN 'cell' WHEN 2 THEN 'a' WHEN 4 THEN 'y' END AS one, CASE g WHEN 1 THEN 'mito' WHEN 2 THEN CASE WHEN mask THEN 'b' END END AS two FROM o),
s AS (SELECT *, concat_ws('; ', CASE WHEN halted THEN 'halted' END, CASE WHEN g = 2 THEN '3 classes without a number for ' || CASE WHEN mask THEN 2 ELSE 1 END || ' label arrays that need one' END) AS stop FROM c),
k AS (SELECT id, dataset, id % 90 + 1 AS num FROM o WHERE id % 9 = 0), t AS (SELECT dataset, max(num) AS top FROM k GROUP BY dataset),
n AS (SELECT s.id, s.dataset, pos, k.num AS had FROM s JOIN (SELECT unnest([1, 2, 3]) AS pos) ON pos <= 1 + s.id % 3 LEFT JOIN k ON k.id = s.id AND pos = 1 WHERE stop = ''),
m AS (SELECT n.id, pos, printf('crop-%03d', coalesce(had, coalesce(top, 0) + row_number() OVER (PARTITION BY n.dataset, had IS NULL ORDER BY n.id, pos))::INT) AS name FROM n LEFT JOIN t ON t.dataset = n.dataset),
x AS (SELECT m.id, string_agg(name || '[raw,label:' || coalesce(one, '-') || ',' || CASE WHEN mask THEN 'label:' || coalesce(two, '-') ELSE '?' END || ']', ' ' ORDER BY pos) AS crops,
 string_agg(concat_ws('; ', CASE WHEN NOT mask THEN name || ': a/mask_b.tif fits no single array' END, CASE WHEN one IS NULL THEN name || ': seg_' || m.id || '.tif has no label class' END,
  CASE WHEN mask AND two IS NULL THEN name || ': a/mask_a.tif has no label class' END), '; ' ORDER BY pos) FILTER (NOT mask OR one IS NULL OR two IS NULL) AS notes FROM m JOIN s ON s.id = m.id GROUP BY m.id)
SELECT s.id AS o_orderkey, stop, concat_ws(',', '1=' || one, '2=' || two) AS classes, coalesce(crops, '') AS crops, coalesce(notes, '') AS notes FROM s LEFT JOIN x ON x.id = s.id""")
def plan_crops(spark, sf):
    """The conversion plan of every order, taken as a record with one to three file sets."""
    k = F.col("o_orderkey")
    array = lambda role, pattern: F.struct(F.lit(role).alias("role"), F.lit(pattern).alias("path_pattern"))
    arrays = F.array(array("raw", "raw_NNN.{tif,tiff}"), array("label", "seg_*.tif"), array("label", "x.zip::<s>/mask_<s>.tif"), array("mesh", "*"), array("label", None))
    mask = F.when(k % 4 == 0, "https://x.org/x.zip::a/mask_a.tif").otherwise("https://x.org/x.zip::a/mask_b.tif")
    files = lambda n: F.array(F.concat(F.lit("https://x.org/raw_"), n, F.lit(".tif?v=1")), F.concat(F.lit("seg_"), k, F.lit(".tif")), mask)
    texts = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    given = F.when(k % 5 == 0, texts("cell")).when(k % 5 == 1, texts("2=mito", "cell")).when(k % 5 == 2, texts("a", "b", "c")).when(k % 5 == 4, texts("1=x", "1=y"))
    records = table(spark, sf, "orders").select(
        k.alias("id"), k.alias("ord"), F.concat(F.lit("d"), F.col("o_custkey") % 40).alias("dataset"), F.when(F.col("o_orderstatus") == "P", texts("halted")).alias("stop"),
        arrays.alias("arrays"), F.transform(F.sequence(F.lit(1), F.lit(1) + k % 3), lambda n: files(n)).alias("file_sets"), given.alias("given"),
    )
    name = F.format_string("crop-%03d", F.col("id") % 90 + 1)
    known = records.where("id % 9 = 0").select("dataset", "id", F.reverse(F.get("file_sets", F.lit(0))).alias("files"), name.alias("name"))
    text = lambda c: F.coalesce(c, F.lit("-"))
    entry = lambda e: F.when(e["role"].isNull(), "?").when(e["role"] == "raw", "raw").otherwise(F.concat(F.lit("label:"), text(e["label_class"])))
    crop = lambda c: F.concat(c["crop"], F.lit("["), F.array_join(F.transform(c["entries"], entry), ","), F.lit("]"))
    classes = F.transform(F.map_entries("classes"), lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"]))
    return planning.plans(records, known).select(
        F.col("id").alias("o_orderkey"), F.array_join("stop", "; ").alias("stop"), F.array_join(classes, ",").alias("classes"),
        F.array_join(F.transform("crops", crop), " ").alias("crops"), F.array_join("notes", "; ").alias("notes"),
    )


@query("""WITH s AS (SELECT l_orderkey, l_linenumber, max(l_quantity) > 47 AS bad FROM lineitem GROUP BY ALL),
f AS (SELECT l_orderkey, count(*) AS steps, min(l_linenumber) FILTER (bad) AS failed_step FROM s GROUP BY l_orderkey)
SELECT 'o' || f.l_orderkey AS crop, CASE WHEN failed_step IS NULL THEN 'done' ELSE 'failed' END AS status,
 (SELECT count(*) FROM s WHERE s.l_orderkey = f.l_orderkey AND (failed_step IS NULL OR s.l_linenumber < failed_step)) AS finished,
 failed_step, CASE WHEN failed_step IS NOT NULL THEN 'over 47' END AS message, 0 AS second_run FROM f""")
def run_resume(spark, sf):
    """Orders as crops, their lines as steps that fail on large quantities: the state after two runs, of which the second finds nothing to do."""
    line = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("quantity"))
    steps = storage.kept(line.select(F.concat(F.lit("o"), "l_orderkey").alias("crop"), F.col("l_linenumber").cast("int").alias("step"), "quantity"), "steps")
    runner = planning.Runner(spark, storage.new_folder(spark, "run"))
    bad = F.col("quantity") > 47
    do = lambda due: due.select("crop", "step", F.when(bad, "error").otherwise("success").alias("status"), F.when(bad, "over 47").alias("message"))
    runner.run(steps, do)
    return runner.summary(steps).withColumn("second_run", F.lit(runner.run(steps, do)))


@query("""WITH c AS (SELECT c_custkey, c_acctbal FROM customer)
SELECT 'first' AS what, c_custkey, c_acctbal FROM c UNION ALL SELECT 'told', c_custkey, 0 FROM c WHERE c_custkey % 6 = 0
UNION ALL SELECT 'last', c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_acctbal END FROM c WHERE c_custkey % 3 <> 1""")
def version_commits(spark, sf):
    """Three writers from one version of the customers: the first wins, the second is told of the rows that the first has changed, the third's rows meet nobody's."""
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").cast("double").alias("c_acctbal"))
    t = versions.VersionedTable(spark, storage.new_folder(spark, "versions"), c.schema, "c_custkey")
    base = t.commit(c, 0)
    t.commit(c.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.lit(0.0)), base)
    try:
        t.commit(c.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.lit(1.0)), base)
        told = c.limit(0)
    except versions.Conflict as conflict:
        told = conflict.rows.select(*c.columns)
    last = t.commit(c.where("c_custkey % 3 = 1").withColumn("_deleted", F.lit(True)), base)
    t.compact()
    seen = {"first": t.read(base), "told": told, "last": t.read(last)}
    first, *rest = [df.select(F.lit(name).alias("what"), "c_custkey", "c_acctbal") for name, df in seen.items()]
    return first.unionByName(rest[0]).unionByName(rest[1])


@query("""WITH p AS (SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' AND p_size > 25 THEN 'Brand#2' WHEN p_brand = 'Brand#5' THEN 'new 2D+t/x' ELSE p_brand END AS place FROM part)
SELECT place, count(*) AS n, sum(p_partkey)::BIGINT AS keys, place NOT IN ('Brand#1', 'Brand#2', 'new 2D+t/x') AS same_files FROM p GROUP BY place""")
def partition_move(spark, sf):
    """Parts in folders by maker, some of which move: folders that no part leaves or enters keep their files."""
    path = storage.new_folder(spark, "places")
    parts = table(spark, sf, "part").select("p_partkey", "p_size", F.col("p_brand").alias("place"))
    parts.write.partitionBy("place").parquet(path)
    files = lambda: spark.read.parquet(path).select("place", F.col("_metadata.file_name").alias("file")).distinct()
    before = storage.kept(files(), "before")
    target = F.when((F.col("place") == "Brand#1") & (F.col("p_size") > 25), "Brand#2").when(F.col("place") == "Brand#5", "new 2D+t/x").otherwise(F.col("place"))
    versions.move_partitions(spark, path, parts.select("p_partkey", target.alias("place")), "p_partkey", ["place"])
    named = lambda df: df.groupBy("place").agg(F.array_sort(F.collect_set("file")).alias("files"))  # noqa: E731 - files of one folder
    same = named(files()).join(named(before).withColumnRenamed("files", "had"), "place", "left").select("place", F.coalesce(F.col("files") == F.col("had"), F.lit(False)).alias("same_files"))
    counts = spark.read.parquet(path).groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.sum("p_partkey").alias("keys"))
    return counts.join(same, "place").select("place", "n", "keys", "same_files")


@query("""WITH p AS (SELECT p_partkey AS k, p_size AS s FROM part)
SELECT k AS p_partkey, CASE k % 5 WHEN 0 THEN (s + 2) || ',' || (s + 1) || ',' || s WHEN 1 THEN (s + 3) || ',' || (s + 2) || ',' || (s + 1) WHEN 2 THEN s || ',' || (s + 1) || ',' || (s + 2) END AS size FROM p""")
def bbox_fill(spark, sf):
    """The size of an array in x, y and z from its shape and axes, where these have all three."""
    k, s = F.col("p_partkey"), F.col("p_size")
    axes = F.when(k % 5 == 0, "zyx").when(k % 5 == 1, "czyx").when(k % 5 == 2, "xyz").when(k % 5 == 3, "yx")
    shape = F.when(k % 5 == 1, F.array(s, s + 1, s + 2, s + 3)).when(k % 5 == 3, F.array(s, s + 1)).otherwise(F.array(s, s + 1, s + 2))
    return table(spark, sf, "part").select("p_partkey", F.array_join(planning.bbox_size(shape, axes), ",").alias("size"))


@query("""WITH n AS (SELECT l_orderkey AS id, l_linenumber AS ix, l_quantity AS q, l_partkey % 3 AS k, CASE WHEN l_linenumber = 1 THEN 'raw' WHEN l_linenumber % 2 = 0 THEN 'label' END AS role, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_shipdate) AS rn FROM lineitem),
e AS (SELECT id, ix, k, role FROM n WHERE rn = 1),
c AS (SELECT id, count(*) FILTER (role = 'label') AS labels, count(*) FILTER (ix = 1) AS raws FROM e GROUP BY id),
o AS (SELECT o_orderkey AS id, o_custkey % 3 AS r FROM orders WHERE o_orderkey IN (SELECT id FROM e)),
x AS (SELECT o.id, o.r, labels, raws FROM o JOIN c ON c.id = o.id)
SELECT id AS o_orderkey, 1 AS step, 'role' AS setting, CASE WHEN raws = 1 THEN NULL ELSE 'the target means ' || raws || ' entries' END AS refusal, CASE WHEN raws = 1 THEN 'label' END AS role, CASE WHEN raws = 1 AND r = 0 THEN 'cell' END AS label_class FROM x
UNION ALL SELECT id, 2, 'label_class', CASE WHEN raws <> 1 THEN 'the target means ' || raws || ' entries' WHEN r > 0 THEN 'a class needs a reason' END, CASE WHEN raws = 1 THEN 'label' END, CASE WHEN raws = 1 AND r = 0 THEN 'cell' END FROM x
UNION ALL SELECT id, 3, 'transform', CASE WHEN labels <> 1 THEN 'the target means ' || labels || ' entries' WHEN r = 1 THEN 'a transform is op:axis or select:axis:index' END, CASE WHEN labels = 1 THEN 'label' END, NULL FROM x""")
def plan_edits(spark, sf):
    """Edits of plans (orders, with a line an entry): what becomes of each, and the entry that it means after all edits."""
    line = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("int").alias("index")).distinct()
    text = F.lit(None).cast("string")
    role = F.when(F.col("index") == 1, "raw").when(F.col("index") % 2 == 0, "label")
    entries = line.withColumns(
        {"crop": F.lit("crop-001"), "key": F.concat(F.lit("k"), "index"), "role": role, "label_class": text, "axes": text, "reader": text, "dataset": text, "dtype": text}
        | {"orientation": F.lit("apply"), "transforms": F.array().cast("array<string>")}
    )
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 3).alias("r")).join(line.select("id").distinct(), "id", "left_semi")
    edit = lambda n, target, setting, value, reason: F.struct(
        F.lit(n).alias("n"), F.lit(target).alias("target"), F.lit(setting).alias("setting"), value.alias("value"), reason.alias("reason")
    )
    said = F.when(F.col("r") == 0, "the record")
    wanted = F.array(
        edit(1, "raw", "role", F.lit("label"), text), edit(2, "raw", "label_class", F.lit("cell"), said),
        edit(3, "label", "transform", F.when(F.col("r") == 1, "flip").when(F.col("r") == 2, "select:c:1").otherwise("flip:y"), F.lit("the header")),
    )
    edits = o.select("id", F.explode(wanted).alias("e")).select((F.col("id") * 10 + F.col("e.n")).alias("ord"), "id", F.lit("crop-001").alias("crop"), "e.target", "e.setting", "e.value", "e.reason")
    after, log = planning.edited(entries, edits)
    rows, place = after.count(), ["id", "index"]
    now = storage.dealt(after.select("id", "index", "role", "label_class"), rows, *place)
    seen = storage.dealt(log, rows, *place).join(now.hint("merge"), place, "left")
    return seen.select(F.col("id").alias("o_orderkey"), (F.col("ord") % 10).cast("int").alias("step"), "setting", "refusal", "role", "label_class")
