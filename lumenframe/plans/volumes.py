"""Array queries; an embedding is a 4 x 4 x 4 volume, or an 8 x 8 image."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import arrays as op
from lumenframe.operators import sampling
from lumenframe.plans import query, table
from lumenframe.sources import storage, voxels

CUBE, SQUARE = (4, 4, 4), (1, 8, 8)
_CUBE = "(SELECT vec_id AS crop, i // 16 AS z, (i // 4) % 4 AS y, i % 4 AS x, embedding[i + 1]::DOUBLE AS v FROM embeddings, generate_series(0, 63) g(i))"
_SQUARE = "(SELECT vec_id AS crop, 0 AS z, i // 8 AS y, i % 8 AS x, embedding[i + 1]::DOUBLE AS v FROM embeddings, generate_series(0, 63) g(i))"


def _cube(spark, sf):
    return op.voxels(table(spark, sf, "embeddings"), "vec_id", "embedding", CUBE)


def _square(spark, sf):
    return op.voxels(table(spark, sf, "embeddings"), "vec_id", "embedding", SQUARE)


def _sums(vox):
    """Checks the place of every value: a weighted sum for each crop."""
    w = F.col("z") * 100 + F.col("y") * 10 + F.col("x") + 1
    return vox.groupBy("crop").agg(F.round(F.sum(F.col("v") * w), 4).alias("sum"), F.count(F.lit(1)).alias("n"))


_SUM = "round(sum(v * (z * 100 + y * 10 + x + 1)), 4) AS sum, count(*) AS n"


@query(f"""SELECT crop, name, {_SUM} FROM (SELECT crop, 'flip y' AS name, z, 7 - y AS y, x, v FROM {_SQUARE} UNION ALL SELECT crop, 'rotate 180', z, 7 - y, 7 - x, v FROM {_SQUARE}
UNION ALL SELECT crop, 'transpose', z, x, y, v FROM {_SQUARE} UNION ALL SELECT crop, 'tiff', z, CASE WHEN o IN (5, 6) THEN x WHEN o IN (7, 8) THEN 7 - x WHEN o IN (3, 4) THEN 7 - y ELSE y END,
 CASE WHEN o IN (5, 8) THEN y WHEN o IN (6, 7) THEN 7 - y WHEN o IN (2, 3) THEN 7 - x ELSE x END, v FROM (SELECT *, crop % 8 + 1 AS o FROM {_SQUARE})) GROUP BY crop, name""")
def orient(spark, sf):
    v = _square(spark, sf)
    out = None
    for name in ("flip y", "rotate 180", "transpose", "tiff"):
        moved = op.orient(v, SQUARE, (F.col("crop") % 8 + 1).cast("int")) if name == "tiff" else op.remap(v, SQUARE, name)
        part = _sums(moved).withColumn("name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""SELECT crop, sum(CASE WHEN floor(v * 10) IN (1, 2, 3) THEN (x * 100 + y * 10 + z + 1) ELSE 0 END)::BIGINT AS mask_sum, bool_and(v = round_even(v, 0)) AS whole, round(sum(CASE WHEN z = 1 THEN v * (x * 10 + y) ELSE 0 END), 4) AS picked FROM {_CUBE} GROUP BY crop""")
def canonical_axes(spark, sf):
    """Axes stored as (c)zyx are read as (x, y, z); a mask of values, a channel pick and the whole-number check."""
    v = _cube(spark, sf)
    place = F.col("x") * 100 + F.col("y") * 10 + F.col("z") + 1
    return v.groupBy("crop").agg(
        F.sum(F.when(F.floor(F.col("v") * 10).isin(1, 2, 3), place).otherwise(0)).alias("mask_sum"),
        F.bool_and(F.col("v") == F.rint("v")).alias("whole"),
        F.round(F.sum(F.when(F.col("z") == 1, F.col("v") * (F.col("x") * 10 + F.col("y"))).otherwise(0.0)), 4).alias("picked"),
    )


@query(f"""WITH p AS (SELECT crop, z, y, x, v FROM {_SQUARE} WHERE y < 7), q AS (SELECT * FROM p UNION ALL SELECT crop, z, 7, x, v FROM p WHERE y = 6)
SELECT crop, y // 2 AS y, x // 2 AS x, round(avg(v), 6) AS v FROM q GROUP BY crop, y // 2, x // 2""")
def down_mean(spark, sf):
    """Seven rows, so the last one counts twice."""
    v = op.down_mean(_square(spark, sf).where("y < 7"), (1, 7, 8), (1, 2, 2))
    return v.select("crop", "y", "x", F.round("v", 6).alias("v"))


_LAB = "(CASE WHEN v > 0.1 THEN 2 WHEN v > 0.03 THEN 1 ELSE 0 END)"


@query(f"""WITH c AS (SELECT crop, z // 2 AS z, y // 2 AS y, x // 2 AS x, {_LAB} AS v, count(*) AS n FROM {_CUBE} GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY crop, z, y, x ORDER BY n - CASE WHEN v = 0 THEN 0.5 ELSE 0 END DESC, v) AS k FROM c) SELECT crop, z, y, x, v::DOUBLE AS v FROM r WHERE k = 1""")
def down_mode(spark, sf):
    lab = F.when(F.col("v") > 0.1, 2).when(F.col("v") > 0.03, 1).otherwise(0).cast("double")
    return op.down_mode(_cube(spark, sf).withColumn("v", lab), CUBE, (2, 2, 2))


@query("""WITH RECURSIVE r AS (SELECT p_partkey, 1 AS level, '' AS plan, false AS over, (p_size % 5 + 1)::DOUBLE AS ez, 1.0::DOUBLE AS ey, (p_size % 3 + 1)::DOUBLE AS ex, p_size::BIGINT * 7 AS nz, p_size::BIGINT * 40 AS ny, 2000::BIGINT AS nx FROM part
 UNION ALL SELECT p_partkey, level + 1, plan || CASE WHEN fz * fy * fx > 1 THEN '/' || fz || fy || fx ELSE '' END, fz * fy * fx = 1, ez * fz, ey * fy, ex * fx, ceil(nz / fz)::BIGINT, ceil(ny / fy)::BIGINT, ceil(nx / fx)::BIGINT FROM (
  SELECT *, CASE WHEN go AND nz > 1 AND ez < 2 * f THEN 2 ELSE 1 END AS fz, CASE WHEN go AND ny > 1 AND ey < 2 * f THEN 2 ELSE 1 END AS fy, CASE WHEN go AND nx > 1 AND ex < 2 * f THEN 2 ELSE 1 END AS fx FROM (
   SELECT *, greatest(nz, ny, nx) > 256 AS go, least(CASE WHEN nz > 1 THEN ez END, CASE WHEN ny > 1 THEN ey END, CASE WHEN nx > 1 THEN ex END) AS f FROM r WHERE level < 8 AND NOT over)))
SELECT p_partkey, substr(arg_max(plan, level), 2) AS plan FROM r GROUP BY p_partkey""")
def pyramid_plan(spark, sf):
    """Factors of the pyramid of shapes and voxel sizes taken from parts, levels joined by slashes."""
    size = F.col("p_size")
    plan = op.level_plan(F.array((size % 5 + 1).cast("double"), F.lit(1.0), (size % 3 + 1).cast("double")), F.array(size * 7, size * 40, F.lit(2000)))
    text = F.array_join(F.transform(plan, lambda f: F.array_join(F.transform(f, lambda x: x.cast("string")), "")), "/")
    return table(spark, sf, "part").select("p_partkey", text.alias("plan"))


@query("""WITH RECURSIVE r AS (SELECT p_partkey, 0 AS k, p_size::BIGINT * 9 AS z, p_size::BIGINT * 30 AS y, 1500::BIGINT AS x FROM part
 UNION ALL SELECT p_partkey, k + 1, CASE WHEN a = 1 THEN greatest(1, z // 2) ELSE z END, CASE WHEN a = 2 THEN greatest(1, y // 2) ELSE y END, CASE WHEN a = 3 THEN greatest(1, x // 2) ELSE x END FROM (
  SELECT *, CASE WHEN z / 32 >= y / 64 AND z / 32 >= x / 64 THEN 1 WHEN y / 64 >= x / 64 THEN 2 ELSE 3 END AS a FROM r WHERE 2 * z * y * x > 4000000)),
s AS (SELECT p_partkey, arg_max(z, k) AS z, arg_max(y, k) AS y, arg_max(x, k) AS x FROM r GROUP BY p_partkey),
m AS (SELECT p_partkey, p_size::BIGINT AS n, z, y, x, (p_size * 9 - z) // 2 AS a, (p_size * 30 - y) // 2 AS b, (1500 - x) // 2 AS c FROM s JOIN part USING (p_partkey)),
t AS (SELECT *, a - a % 32 AS za, b - b % 64 AS ya, c - c % 64 AS xa FROM m)
SELECT p_partkey, za || ':' || least(n * 9, za + z) || ',' || ya || ':' || least(n * 30, ya + y) || ',' || xa || ':' || least(1500, xa + x) AS crop FROM t""")
def crop_spec(spark, sf):
    """Central crops, snapped to chunks, that fit a limit."""
    size = F.col("p_size")
    box = op.central_crop(F.array(size * 9, size * 30, F.lit(1500)), 2, F.array(F.lit(32), F.lit(64), F.lit(64)), 4_000_000)
    text = F.array_join(F.transform(box, lambda b: F.concat(b["start"].cast("string"), F.lit(":"), b["stop"].cast("string"))), ",")
    return table(spark, sf, "part").select("p_partkey", text.alias("crop"))


@query(f"""WITH p AS (SELECT crop, quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM {_CUBE} GROUP BY crop)
SELECT c.crop AS crop, sum(floor(least(greatest(round((v - lo) / (hi - lo), 9), 0), 1) * 255))::BIGINT AS total, count_if(v <= lo) AS low, count_if(v >= hi) AS high FROM {_CUBE} c JOIN p ON c.crop = p.crop GROUP BY c.crop""")
def window_clip(spark, sf):
    v = _cube(spark, sf)
    p = v.groupBy("crop").agg(F.percentile("v", F.array(F.lit(0.01), F.lit(0.99))).alias("p")).select("crop", F.col("p")[0].alias("lo"), F.col("p")[1].alias("hi"))
    j = v.join(p, "crop")
    share = F.least(F.greatest(F.round((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")), 9), F.lit(0.0)), F.lit(1.0))
    return j.groupBy("crop").agg(F.sum(F.floor(share * 255)).alias("total"), F.count_if(F.col("v") <= F.col("lo")).alias("low"), F.count_if(F.col("v") >= F.col("hi")).alias("high"))


@query(f"""SELECT crop, count(*) AS n, round(min(v), 6) AS min, round(max(v), 6) AS max, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(quantile_cont(v, 0.01), 6) AS p1, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.999), 6) AS p999,
round(avg((v = 0)::INT), 6) AS zero_fraction, CASE WHEN min(v) >= 0 AND max(v) <= 1 THEN 'values in [0, 1]' WHEN abs(avg(v)) < 0.1 AND stddev_pop(v) > 0.8 AND stddev_pop(v) < 1.2 THEN 'standardized' ELSE '' END AS hint
FROM (SELECT crop, z, y, x, CASE WHEN crop % 3 = 0 THEN abs(v) WHEN crop % 3 = 1 THEN v * 8 ELSE v * 100 END AS v FROM {_CUBE}) GROUP BY crop""")
def array_profile(spark, sf):
    k = F.col("crop") % 3
    v = _cube(spark, sf).withColumn("v", F.when(k == 0, F.abs("v")).when(k == 1, F.col("v") * 8).otherwise(F.col("v") * 100))
    r = lambda c, n: F.round(c, 6).alias(n)
    return op.profile(v).select("crop", "n", r("min", "min"), r("max", "max"), r("mean", "mean"), r("std", "std"), r(F.col("p")[1], "p1"), r(F.col("p")[2], "p50"), r(F.col("p")[4], "p999"), r("zero_fraction", "zero_fraction"), "hint")


@query(f"""WITH s AS (SELECT crop, count_if(v > 0) AS na, count_if(v > 0.1) AS nb, count_if(v > 0 AND v > 0.1) AS nab FROM {_CUBE} GROUP BY crop)
SELECT crop, 'any' AS a, 'high' AS b, round(nab / greatest(na, 1)::DOUBLE, 3) AS share FROM s UNION ALL SELECT crop, 'high', 'any', round(nab / greatest(nb, 1)::DOUBLE, 3) FROM s""")
def channel_containment(spark, sf):
    return op.containment(_cube(spark, sf), {"any": F.col("v") > 0, "high": F.col("v") > 0.1})


@query(f"SELECT crop, cls, count(*) AS n, sum(z * 16 + y * 4 + x)::BIGINT AS places FROM (SELECT crop, z, y, x, unnest(CASE WHEN {_LAB} = 2 THEN ['bright', 'all'] WHEN {_LAB} = 1 THEN ['dim', 'all'] ELSE []::VARCHAR[] END) AS cls FROM {_CUBE}) GROUP BY crop, cls")
def split_classes(spark, sf):
    """One label volume becomes a mask for each class; classes are lists of values."""
    lab = F.when(F.col("v") > 0.1, 2).when(F.col("v") > 0.03, 1).otherwise(0)
    classes = spark.createDataFrame([("bright", [2]), ("dim", [1]), ("all", [1, 2])], "cls string, vals array<int>").select("cls", F.explode("vals").alias("lab"))
    v = _cube(spark, sf).withColumn("lab", lab).join(F.broadcast(classes), "lab")  # a row for each class value
    return v.groupBy("crop", "cls").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("z") * 16 + F.col("y") * 4 + F.col("x")).alias("places"))


_EDGES = f"""(SELECT *, coalesce(abs(lead(v) OVER (PARTITION BY crop, z, x ORDER BY y) - v), 0) + coalesce(abs(lead(v) OVER (PARTITION BY crop, z, y ORDER BY x) - v), 0) AS gradient,
 coalesce(lag(lab) OVER (PARTITION BY crop, z, x ORDER BY y) <> lab, FALSE) OR coalesce(lag(lab) OVER (PARTITION BY crop, z, y ORDER BY x) <> lab, FALSE) AS boundary FROM (SELECT *, {_LAB} AS lab FROM {_SQUARE}))"""


@query(f"""WITH e AS (SELECT * FROM {_EDGES}), m AS (SELECT crop, z, y, x FROM e WHERE lab > 0),
ring AS (SELECT DISTINCT e.crop, e.z, e.y, e.x FROM e JOIN m ON e.crop = m.crop AND e.z = m.z AND abs(e.y - m.y) + abs(e.x - m.x) <= 3 WHERE e.lab = 0),
j AS (SELECT e.*, ring.crop IS NOT NULL AS around FROM e LEFT JOIN ring ON e.crop = ring.crop AND e.z = ring.z AND e.y = ring.y AND e.x = ring.x)
SELECT crop, round(avg((lab > 0)::INT), 6) AS fg, CASE WHEN avg((lab > 0)::INT) > 0 AND avg((lab > 0)::INT) < 1 THEN round(abs(avg(v) FILTER (lab > 0) - coalesce(avg(v) FILTER (around), avg(v) FILTER (lab = 0))) / stddev_pop(v), 6) END AS interior,
CASE WHEN avg((lab > 0)::INT) > 0 AND avg((lab > 0)::INT) < 1 THEN round(avg(gradient) FILTER (boundary) / greatest(avg(gradient), 1e-9), 6) END AS boundary FROM j GROUP BY crop""")
def gradient_boundary(spark, sf):
    v = _square(spark, sf)
    lab = v.select("crop", *op.ZYX, F.when(F.col("v") > 0.1, 2).when(F.col("v") > 0.03, 1).otherwise(0).alias("lab"))
    return op.scores(v, lab).select("crop", *[F.round(c, 6).alias(c) for c in ("fg", "interior", "boundary")])


def _candidate(name: str, y: str, x: str) -> str:
    lab = "CASE WHEN crop % 4 = 0 THEN rv > 0.05 ELSE v > 0.05 END"
    return f"SELECT a.crop, '{name}' AS name, a.z, a.y, a.x, a.v, ({lab.replace('crop', 'a.crop').replace('rv', 'r.v').replace(' v >', ' b.v >')})::INT AS lab FROM {_SQUARE} a JOIN {_SQUARE} b ON b.crop = a.crop AND b.y = {y} AND b.x = {x} JOIN {_SQUARE} r ON r.crop = a.crop AND r.y = 7 - b.y AND r.x = b.x"


@query(f"""WITH c AS ({" UNION ALL ".join(_candidate(n, y, x) for n, y, x in (("stored", "a.y", "a.x"), ("flip z", "a.y", "a.x"), ("flip y", "7 - a.y", "a.x"), ("flip x", "a.y", "7 - a.x"), ("rotate 180", "7 - a.y", "7 - a.x"), ("transpose", "a.x", "a.y")))}),
e AS (SELECT *, coalesce(abs(lead(v) OVER (PARTITION BY name, crop, x ORDER BY y) - v), 0) + coalesce(abs(lead(v) OVER (PARTITION BY name, crop, y ORDER BY x) - v), 0) AS gradient,
 coalesce(lag(lab) OVER (PARTITION BY name, crop, x ORDER BY y) <> lab, FALSE) OR coalesce(lag(lab) OVER (PARTITION BY name, crop, y ORDER BY x) <> lab, FALSE) AS boundary FROM c),
ring AS (SELECT DISTINCT e.name, e.crop, e.y, e.x FROM e JOIN e m ON e.crop = m.crop AND e.name = m.name AND m.lab > 0 AND abs(e.y - m.y) + abs(e.x - m.x) <= 3 WHERE e.lab = 0),
s AS (SELECT e.crop AS crop, e.name AS name, avg((lab > 0)::INT) AS fg, abs(avg(v) FILTER (lab > 0) - coalesce(avg(v) FILTER (ring.crop IS NOT NULL), avg(v) FILTER (lab = 0))) / stddev_pop(v) AS interior, avg(gradient) FILTER (boundary) / greatest(avg(gradient), 1e-9) AS boundary
 FROM e LEFT JOIN ring ON e.crop = ring.crop AND e.name = ring.name AND e.y = ring.y AND e.x = ring.x GROUP BY e.crop, e.name),
k AS (SELECT *, CASE WHEN fg > 0 AND fg < 1 THEN round(CASE WHEN fg > 0.6 THEN boundary ELSE interior END, 6) END AS score FROM s),
g AS (SELECT crop, max(score) FILTER (name = 'stored') AS own, max(score) FILTER (name <> 'stored') AS other, max(interior) FILTER (name = 'stored') AS i, max(boundary) FILTER (name = 'stored') AS b, max({{'s': score, 'n': name}}) FILTER (name <> 'stored' AND score IS NOT NULL) AS top FROM k GROUP BY crop)
SELECT crop, CASE WHEN own IS NULL THEN 'unverified' WHEN other >= 1.3 * own THEN 'fail' WHEN i < 0.25 AND b < 1.15 THEN 'unverified' WHEN other >= 0.9 * own THEN 'unverified' ELSE 'pass' END AS verdict, CASE WHEN own IS NOT NULL THEN top.n END AS best FROM g""")
def align_verdict(spark, sf):
    """Every fourth crop has its labels flipped along y."""
    v = _square(spark, sf)
    flipped = op.remap(v, SQUARE, "flip y").select("crop", *op.ZYX, F.col("v").alias("rv"))
    lab = v.join(flipped, ["crop", *op.ZYX]).select("crop", *op.ZYX, (F.when(F.col("crop") % 4 == 0, F.col("rv")).otherwise(F.col("v")) > 0.05).cast("int").alias("lab"))
    return op.alignment(v, lab, SQUARE)


@query()
def best_shift(spark, sf):
    """Labels are the image shifted by one along x for odd crops."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("crop"), F.col("embedding").cast("array<double>").alias("v"))
    rolled = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.get("v", F.when(F.col("crop") % 2 == 1, F.floor(i / 8) * 8 + (i + 1) % 8).otherwise(i).cast("int")))
    return op.best_shift(e.select("crop", "v", F.transform(rolled, lambda a: (a > 0.05).cast("int")).alias("lab")), SQUARE)


@query(f"""WITH c AS (SELECT crop, count_if(v > 0.6) AS loud, count_if(v > 0) / 64.0 AS fg FROM {_CUBE} GROUP BY crop)
SELECT crop, 0::BIGINT AS differing, CASE WHEN crop % 50 = 7 THEN 1 ELSE 0 END::BIGINT AS changed, CASE WHEN crop % 50 = 7 THEN 'fail' WHEN fg > 0.55 THEN 'unverified' ELSE 'pass' END AS overall FROM c""")
def identity_check(spark, sf):
    """Flipped twice is the same; a voxel changed on purpose is found; checks are reduced to one status."""
    v = _cube(spark, sf)
    twice = op.remap(op.remap(v, CUBE, "rotate 180"), CUBE, "rotate 180")
    broken = v.withColumn("v", F.when((F.col("crop") % 50 == 7) & (F.col("z") + F.col("y") + F.col("x") == 0), F.col("v") + 1).otherwise(F.col("v")))
    same, found = op.same_voxels(v, twice), op.same_voxels(v, broken).withColumnRenamed("differing", "changed")
    fill = v.groupBy("crop").agg((F.count_if(F.col("v") > 0) / 64).alias("fg"))
    j = same.join(found, "crop").join(fill, "crop")
    checks = F.array(F.when(F.col("differing") > 0, "fail").otherwise("pass"), F.when(F.col("changed") > 0, "fail").otherwise("pass"), F.when(F.col("fg") > 0.55, "unverified").otherwise("pass"))
    each = j.select("crop", "differing", "changed", F.explode(checks).alias("status"))
    return each.groupBy("crop", "differing", "changed").agg(op.overall(F.col("status")).alias("overall"))


@query("SELECT vec_id, round(d / w, 4) AS last, CASE WHEN vec_id % 5 > 0 THEN round(64.0 / (vec_id % 5), 4) END AS first FROM (SELECT vec_id, 64.0 AS d, (vec_id % 7 + 1) AS w FROM embeddings)")
def shape_compare(spark, sf):
    k = F.col("vec_id")
    n = F.size("embedding").cast("long")
    ratio = op.shape_ratio(F.array(F.lit(3).cast("long"), n, n), F.array(k % 5, k % 7 + 1))
    return table(spark, sf, "embeddings").select("vec_id", ratio[1].alias("last"), ratio[0].alias("first"))


_PARTS = "SELECT p_partkey // 100 AS z, p_partkey // 10 % 10 AS y, p_partkey % 10 AS x, p_size AS v FROM part"


@query(f"""WITH a AS ({_PARTS}), n AS (SELECT max(z) AS top FROM a),
b AS (SELECT z, y // 2 AS y, x // 2 AS x, round_even(avg(v), 0) AS v FROM a GROUP BY ALL),
d AS (SELECT unnest([0, 1]) AS d),
c AS (SELECT g.z, g.y, g.x, round_even(avg(b.v), 0) AS v FROM (SELECT DISTINCT z // 2 AS z, y // 2 AS y, x // 2 AS x FROM b) g, d dz, d dy, d dx, n, b
  WHERE b.z = least(2 * g.z + dz.d, top) AND b.y = least(2 * g.y + dy.d, 4) AND b.x = least(2 * g.x + dx.d, 4) GROUP BY ALL)
SELECT 's0' AS level, z, y, x, v::BIGINT AS v, 0 AS faults FROM a WHERE z BETWEEN 3 AND 9 AND x < 4 UNION ALL SELECT 's1', z, y, x, v::BIGINT, 0 FROM b UNION ALL SELECT 's2', z, y, x, v::BIGINT, 0 FROM c""")
def voxel_pyramid(spark, sf):
    """Parts as an array in chunks with two further levels, read back: of the first level a crop, of the others all, and the faults of the pyramid."""
    k = F.col("p_partkey")
    vox = table(spark, sf, "part").select(F.floor(k / 100).alias("z"), (F.floor(k / 10) % 10).alias("y"), (k % 10).alias("x"), F.col("p_size").alias("v"))
    depth = vox.agg(F.max("z")).first()[0] + 1
    path = storage.new_folder(spark, "pyramid")
    names = voxels.write_multiscale(vox, path, (depth, 10, 10), "uint16", (30, 8, 8), [(1, 2, 2), (2, 2, 2)], chunk=(8, 4, 4))
    faults = voxels.pyramid_faults(spark, path).count()
    levels = {n: voxels.read(spark, f"{path}/{n}") for n in names}
    levels["s0"] = levels["s0"].where("z BETWEEN 3 AND 9 AND x < 4")
    first, *rest = [df.select(F.lit(n).alias("level"), "z", "y", "x", F.col("v").cast("long").alias("v"), F.lit(faults).alias("faults")) for n, df in levels.items()]
    return first.union(rest[0]).union(rest[1])


def _centre(step: float, i: str, n: int) -> str:
    return f"least(greatest(({i} + 0.5) * {step}::DOUBLE - 0.5, 0), {n - 1})"


_GRID = ", ".join(f"generate_series(0, {m - 1}) g{a}(i{a})" for a, m in zip("zyx", (8, 2, 3), strict=True))
_BY = {"z": 0.5, "y": 2.0, "x": 4 / 3}
_WEIGHT = " * ".join(f"greatest(1 - abs({_centre(s, f'i{a}', 4)} - v.{a}), 0)" for a, s in _BY.items())
_NEAREST = " AND ".join(f"v.{a} = floor({_centre(s, f'i{a}', 4)} + 0.5)" for a, s in _BY.items())


@query(f"""WITH v AS {_CUBE}
SELECT 'image' AS kind, crop, iz AS z, iy AS y, ix AS x, sum(v * {_WEIGHT}) AS v FROM v, {_GRID} GROUP BY ALL
UNION ALL SELECT 'label', crop, iz, iy, ix, max(floor(v * 8)) FROM v, {_GRID} WHERE {_NEAREST} GROUP BY ALL""")
def resample(spark, sf):
    """Embeddings as volumes at another voxel size, as images and as labels."""
    size, target = (2.0, 1.0, 1.5), (1.0, 2.0, 2.0)
    vox = _cube(spark, sf)
    image = sampling.resampled(vox, CUBE, size, target)
    label = sampling.resampled(vox.withColumn("v", F.floor(F.col("v") * 8).cast("double")), CUBE, size, target, "label")
    named = lambda df, kind: df.select(F.lit(kind).alias("kind"), "crop", *op.ZYX, "v")
    return named(image, "image").unionByName(named(label, "label"))


_DRAW = "(('0x' || substr(md5('7:2:' || id || ':' || s || ':{}'), 1, 13))::BIGINT / 4503599627370496.0)"


@query(f"""WITH p AS (SELECT p_partkey AS id, 90 + p_size * 3 AS nx, 100 + p_size * 2 AS ny, 4 + p_size AS nz FROM part WHERE p_partkey % 7 > 0 AND least(90 + p_size * 3, 100 + p_size * 2) >= 128),
d AS (SELECT *, 64 + {_DRAW.format('x')} * (nx - 128) AS cx, 64 + {_DRAW.format('y')} * (ny - 128) AS cy, floor({_DRAW.format('z')} * nz) AS cz FROM p, (SELECT unnest([0, 1, 2]) AS s)),
f AS (SELECT *, ceil(nx / f)::INT AS lx, ceil(ny / f)::INT AS ly, CASE WHEN f = 8 THEN ceil(nz / 2)::INT ELSE nz END AS lz, CASE WHEN f = 8 THEN 2 ELSE 1 END AS fz FROM d, (SELECT unnest([1, 2, 8]) AS f)),
g AS (SELECT id, s, f, greatest(0, least(round_even(cx / f - 8, 0), lx - 16))::INT AS x0, greatest(0, least(round_even(cy / f - 8, 0), ly - 16))::INT AS y0, least(floor(cz / fz), lz - 1)::INT AS z0 FROM f)
SELECT id AS p_partkey, s AS sample, f AS factor, x0, y0, z0, x0 * 4.0 * f + 2.0 * (f - 1) AS low_x, (y0 + 15) * 4.0 * f + 2.0 * (f - 1) AS high_y FROM g""")
def patch_sampler(spark, sf):
    """Three places in each of the parts, taken as arrays, with a patch of 16 around it at three levels."""
    nx, ny, nz = 90 + F.col("p_size") * 3, 100 + F.col("p_size") * 2, 4 + F.col("p_size")
    xyz = lambda x, y, z: F.struct(x.alias("x"), y.alias("y"), z.alias("z"))

    def level(f):
        d = lambda v: F.lit(float(v))
        down = 2 if f == 8 else 1
        shape = xyz(F.ceil(nx / f).cast("int"), F.ceil(ny / f).cast("int"), F.ceil(nz / down).cast("int"))
        return F.struct(xyz(d(4 * f), d(4 * f), d(30 * down)).alias("scale"), xyz(d(2 * (f - 1)), d(2 * (f - 1)), d(0)).alias("translation"), shape.alias("shape"))

    levels = F.when(F.col("p_partkey") % 7 > 0, F.array(level(1), level(2), level(8))).otherwise(F.array(level(1), level(8)))
    arrays = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), levels.alias("levels"))
    found = sampling.patch_samples(arrays, 3, 16, (1, 2, 8), seed=7, epoch=2)
    return found.select(F.col("id").alias("p_partkey"), "sample", "factor", "x0", "y0", "z0", F.col("low")[0].alias("low_x"), F.col("high")[1].alias("high_y"))
