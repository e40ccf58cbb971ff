"""Crawls over stored answers: folders and continuation pages followed by an iterated frontier join.

An answer is what a server said to one address: entries (files and folders) and, if it broke off, the address of
the rest. From its roots a crawl joins the frontier with the answers, level by level; folders not seen before
and the pages that continue an answer are the next frontier. Budgets of folders, files and depth hold for each
root and are reported, never silent. Every level is written to the shared folder, so a lost executor repeats one level.

Within a level folders are read in the order of their addresses; a folder is read while the root has
read fewer than ``max_dirs`` folders, and fewer than ``max_files`` files were found in the levels before and in the folders
before it. A row's rank within its root is cut to the budget before the shuffle, so a folder with millions of
subfolders is not sorted by one task.

Defined results: a folder without an answer has no entries and is reported; entries outside the folder (parents, other hosts)
are left out; a file found twice under one root counts once; a null address is none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.sources import storage

#: The shape of stored answers.
ANSWERS = "url string, entries array<struct<name: string, size: bigint, folder: boolean>>, next string"


def crawl(roots: DataFrame, answers: DataFrame, max_dirs: int = 200, max_files: int = 50_000, max_depth: int = 64) -> tuple[DataFrame, DataFrame]:
    """(files, summary). roots: (root), addresses with a slash at the end; answers: of the shape ANSWERS.

    files: (root, path, size, url), the path below the root. summary: (root, n_dirs, n_files, complete, problems).
    """
    start = roots.select("root").where("root IS NOT NULL").distinct()
    frontier = start.select("root", F.col("root").alias("url"), F.col("root").alias("folder"), F.lit(True).alias("is_dir"))
    read: DataFrame | None = None
    files: list[DataFrame] = []
    cut: list[DataFrame] = []
    order = Window.partitionBy("root").orderBy("url")
    for depth in range(max_depth + 1):
        # what each root has read so far
        if read is None:
            sofar = start.select("root", F.lit(0).cast("long").alias("dirs"), F.lit(0).cast("long").alias("found"))
        else:
            sofar = read.groupBy("root").agg(F.count_if("is_dir").alias("dirs"), F.sum("n").alias("found"))
        pages = frontier.where("NOT is_dir").withColumn("rank", F.lit(0))
        dirs = frontier.where("is_dir").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max_dirs)
        allowed = dirs.unionByName(pages).join(sofar, "root", "left")
        allowed = allowed.where((F.coalesce("dirs", F.lit(0)) + F.col("rank") <= max_dirs) & (F.coalesce("found", F.lit(0)) < max_files))
        got = allowed.join(answers.select("url", "entries", "next", F.lit(True).alias("answered")), "url", "left")
        n = F.coalesce(F.size(F.filter("entries", lambda e: ~e["folder"])), F.lit(0))
        before = F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, -1))  # at most max_dirs folders and the open pages of a root
        got = got.withColumn("n", n).withColumn("before", F.coalesce(before, F.lit(0)) + F.coalesce("found", F.lit(0)))
        got = storage.kept(got.where(F.col("before") < max_files).drop("before", "rank", "dirs", "found"), f"crawl-{depth}")
        entries = got.select("root", "folder", F.explode("entries").alias("e"))
        target = F.concat("folder", "e.name")
        inside = entries.where(~F.col("e.name").rlike(r"^(/|\.{1,2}(/|$)|[a-z][a-z0-9+.-]*:)") & (F.col("e.name") != ""))
        files.append(inside.where("NOT e.folder").select("root", F.expr("substring(concat(folder, e.name), char_length(root) + 1)").alias("path"), "e.size", target.alias("url")))
        seen = got.select("root", "url", "is_dir", "n", F.coalesce("answered", F.lit(False)).alias("answered"))
        read = seen if read is None else read.unionByName(seen)
        left_out = frontier.join(got.select("root", "url"), ["root", "url"], "left_anti").select("root", F.lit("budget of folders or files").alias("problem"))
        cut.append(left_out)
        folders = inside.where("e.folder").select("root", target.alias("url"), target.alias("folder"), F.lit(True).alias("is_dir"))
        rest = got.where("next IS NOT NULL").select("root", F.col("next").alias("url"), "folder", F.lit(False).alias("is_dir"))
        coming = folders.unionByName(rest).dropDuplicates(["root", "url"]).join(read.select("root", "url"), ["root", "url"], "left_anti")
        frontier = storage.kept(coming, f"frontier-{depth + 1}")
        if frontier.isEmpty():
            break
    else:
        cut.append(frontier.select("root", F.lit("budget of depth").alias("problem")))
    every, problems = files[0], cut[0]
    for more in files[1:]:
        every = every.unionByName(more)
    for more in cut[1:]:
        problems = problems.unionByName(more)
    problems = problems.unionByName(read.where("NOT answered").select("root", F.lit("no answer from a folder").alias("problem")))
    every = every.dropDuplicates(["root", "url"])
    told = problems.groupBy("root").agg(F.array_sort(F.collect_set("problem")).alias("problems"))  # three texts at most
    counts = every.groupBy("root").agg(F.count(F.lit(1)).alias("n_files"))
    dirs = read.where("is_dir").groupBy("root").agg(F.count(F.lit(1)).alias("n_dirs"))
    summary = start.join(dirs, "root", "left").join(counts, "root", "left").join(told, "root", "left")
    none = F.array().cast("array<string>")
    return every, summary.select(
        "root", F.coalesce("n_dirs", F.lit(0)).alias("n_dirs"), F.coalesce("n_files", F.lit(0)).alias("n_files"),
        F.col("problems").isNull().alias("complete"), F.coalesce("problems", none).alias("problems"),
    )
