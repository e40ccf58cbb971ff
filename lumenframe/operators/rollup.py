"""Directory roll-ups and size estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.functions.text import extension

#: Bytes of one value of each type.
DTYPE_BYTES = {"bool": 1, "uint8": 1, "int8": 1, "uint16": 2, "int16": 2, "float16": 2, "uint32": 4, "int32": 4, "float32": 4, "uint64": 8, "int64": 8, "float64": 8, "complex64": 8}


def collapse_dirs(files: DataFrame, dirs_col: str, depth: int, siblings: int = 3, first: int = 0) -> DataFrame:
    """Adds ``dir``: the directories of ``dirs_col`` (an array) with runs of digits as ``#`` where at least
    ``siblings`` names under the same, already collapsed, parent share that form.

    Level by level, as a level depends on those above. Each level counts distinct names per (parent, form),
    one row per distinct directory, and joins the result back; ``depth`` is a schema-like bound on levels. Levels before
    ``first`` stay as they are.
    """
    dirs = files.select(dirs_col).distinct().withColumn("_d", F.col(dirs_col))
    for level in range(first, depth):
        part = F.get("_d", F.lit(level))
        dirs = dirs.withColumn("_parent", F.array_join(F.slice("_d", 1, level), "/")).withColumn("_form", F.regexp_replace(part, r"\d+", "#"))
        many = (
            dirs.where(F.size("_d") > level)
            .groupBy("_parent", "_form")
            .agg(F.count_distinct(part).alias("_n"))
            .where(F.col("_n") >= siblings)
        )
        dirs = dirs.join(many, ["_parent", "_form"], "left").withColumn(
            "_d",
            F.when(F.col("_n").isNotNull(), F.concat(F.slice("_d", 1, level), F.array("_form"), F.slice("_d", level + 2, F.greatest(F.size("_d") - level - 1, F.lit(0))))).otherwise(F.col("_d")),
        ).drop("_parent", "_form", "_n")
    return files.join(dirs, dirs_col).withColumn("dir", F.array_join("_d", "/")).drop("_d")


def dir_stats(files: DataFrame) -> DataFrame:
    """(dir, n_files, bytes, any_unknown, n_dirs, extensions) from (dir, dirs, path, size).

    Extensions are the four most frequent, by count then name; counted before they are ranked.
    """
    base = files.groupBy("dir").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum(F.coalesce("size", F.lit(0))).alias("bytes"),
        F.bool_or(F.col("size").isNull()).alias("any_unknown"),
        F.count_distinct("dirs").alias("n_dirs"),
    )
    n = files.groupBy("dir", extension(F.col("path")).alias("ext")).agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("dir").orderBy(F.desc("n"), "ext"))
    top = n.withColumn("rank", rank).where("rank <= 4").groupBy("dir").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "ext", "n"))), lambda e: F.concat(F.lit("."), e["ext"], F.lit(" "), e["n"].cast("string"))), ", ").alias("extensions")
    )
    return base.join(top, "dir")


#: Fixed value: files of version control and operating systems, which belong to no dataset.
JUNK = r"(^|/)(\.svn|\.git|__MACOSX)/|(^|/)(\.DS_Store|Thumbs\.db|\._[^/]*)$"
_STORE = r"(?i)^(.*?\.(zarr|n5))/.*$"


def common_folder(dirs: Column) -> Column:
    """The longest common beginning of arrays, as an aggregate: that of the smallest and the largest of them."""
    low, high = F.min(dirs), F.max(dirs)
    length = F.least(F.size(low), F.size(high))
    differ = F.filter(F.sequence(F.lit(0), length), lambda i: (i == length) | ~F.get(low, i).eqNullSafe(F.get(high, i)))
    return F.slice(low, 1, F.get(differ, F.lit(0)))


def directory_tree(files: DataFrame, by: str) -> DataFrame:
    """(by, prefix, dir, n_files, bytes, any_unknown, n_dirs, extensions, hidden): the folders of each listing.

    files: (by, path, size). Junk is counted (``hidden``) and left out, chunks inside a .zarr or .n5 store count
    for one line of the store, the longest common folder of a listing is its ``prefix``, and numbered
    siblings are one line. Defined results: a listing of junk alone has one row with a null ``dir``; null paths are no files.
    """
    listed = files.where(F.col("path").isNotNull()).select(F.col(by).cast("string").alias("_by"), "path", "size", F.col("path").rlike(JUNK).alias("_junk"))
    store = F.regexp_extract("path", _STORE, 1)
    inside = F.concat(store, F.lit("/(store)."), F.lower(F.regexp_extract("path", _STORE, 2)))
    kept = listed.where("NOT _junk").withColumn("path", F.when(store != "", inside).otherwise(F.col("path")))
    parts = F.split("path", "/")
    kept = kept.withColumn("_dirs", F.slice(parts, 1, F.size(parts) - 1))
    whole = listed.groupBy("_by").agg(F.count_if("_junk").alias("hidden"))
    prefix = kept.groupBy("_by").agg(common_folder(F.col("_dirs")).alias("_prefix"))
    near = prefix.withColumnRenamed("_by", "_of")
    cut = kept.join(near, F.col("_by").eqNullSafe(F.col("_of"))).withColumn("_rest", F.slice("_dirs", F.size("_prefix") + 1, F.size("_dirs")))
    rows = cut.select("path", "size", F.concat(F.array(F.coalesce(F.concat(F.lit("="), "_by"), F.lit("-"))), "_rest").alias("dirs"))
    depth = rows.agg(F.max(F.size("dirs"))).first()[0] or 1
    stats = dir_stats(collapse_dirs(rows, "dirs", depth, first=1))
    key = F.regexp_extract("dir", "^([^/]*)", 1)
    stats = stats.withColumn("_by", F.when(key != "-", F.substring(key, 2, 1 << 30))).withColumn("dir", F.regexp_replace("dir", "^[^/]*/?", ""))
    w, p, t = whole.alias("w"), prefix.alias("p"), stats.alias("s")
    out = w.join(p, F.col("w._by").eqNullSafe(F.col("p._by")), "left").join(t, F.col("w._by").eqNullSafe(F.col("s._by")), "left")
    told = [f"s.{c}" for c in ("dir", "n_files", "bytes", "any_unknown", "n_dirs", "extensions")]
    return out.select(F.col("w._by").alias(by), F.array_join("p._prefix", "/").alias("prefix"), *told, "w.hidden")


def listing_totals(files: DataFrame, complete: Column, exact: Column) -> DataFrame:
    """One row: n_files, bytes, complete, exact and where the size is from; an empty listing is never confirmed."""
    t = files.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.coalesce(F.bool_and(complete), F.lit(True)).alias("complete"), F.coalesce(F.bool_and(exact), F.lit(True)).alias("exact"))
    source = F.when((F.col("n_files") > 0) & F.col("complete") & F.col("exact"), "file-listing").otherwise("estimated")
    return t.withColumn("size_source", source)


def product(shape: Column) -> Column:
    return F.aggregate(shape, F.lit(1).cast("long"), lambda a, x: a * x.cast("long"))


def estimate(parts: DataFrame, by: str) -> DataFrame:
    """(by, total_bytes, missing): files x product of the shape x width, null if one part can't be told.

    parts: (by, files, shape, dtype).
    """
    width = F.coalesce(*[F.when(F.col("dtype") == k, F.lit(v)) for k, v in DTYPE_BYTES.items()])
    good = F.coalesce((F.size("shape") > 0) & F.forall("shape", lambda s: s.isNotNull() & (s > 0)), F.lit(False))
    size = F.when(good & (F.col("files") > 0), F.col("files") * product(F.col("shape")) * width)
    n = parts.select(by, size.alias("b")).groupBy(by).agg(F.sum("b").alias("s"), F.count_if(F.col("b").isNull()).alias("missing"))
    return n.select(by, F.when(F.col("missing") == 0, F.col("s")).alias("total_bytes"), "missing")
