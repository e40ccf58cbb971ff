"""Readers and sinks of the catalog's own files: YAML records, run logs, key lists, state tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: Fixed shape of a run log.
RUN_LOG = (
    "routine string, started_at string, finished_at string, status string, dry_run boolean, target bigint, queries array<string>, "
    "fetched_urls array<string>, events array<struct<type:string,id:string,reason:string,pr_url:string,at:string>>, "
    "counts map<string,bigint>, pr_urls array<string>, "
    "inspected array<struct<kind:string,url:string,id:string,at:string,bytes:bigint>>, stop_reason string, duration_s bigint"
)


@F.pandas_udf(StringType())
def yaml_to_json(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """A YAML document as JSON text; dates stay text, unreadable or null documents give null."""
    import json

    import yaml

    class Plain(yaml.SafeLoader):
        """YAML's core types without timestamps."""

    Plain.yaml_implicit_resolvers = {
        first: [pair for pair in pairs if pair[0] != "tag:yaml.org,2002:timestamp"]
        for first, pairs in yaml.SafeLoader.yaml_implicit_resolvers.items()
    }

    def convert(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            return json.dumps(yaml.load(text, Loader=Plain), ensure_ascii=False)  # noqa: S506 - a SafeLoader
        except (yaml.YAMLError, TypeError, ValueError):
            return None

    for batch in texts:
        yield batch.map(convert, na_action="ignore")


def read_yaml(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """YAML files below ``path``, one row each: ``path`` (decoded by Spark itself, so that ``2D+t``
    stays as it is), ``readable`` and the fields of ``schema``; unreadable files have null fields."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.y*ml").text(path, wholetext=True)
    rows = files.select(F.col("_metadata.file_path").alias("path"), yaml_to_json("value").alias("json"))
    parsed = rows.select("path", F.col("json").isNotNull().alias("readable"), F.from_json("json", schema).alias("r"))
    return parsed.select("path", "readable", "r.*")


def read_run_logs(spark: SparkSession, local: str, shared: str | None = None, dry_runs: bool = False) -> DataFrame:
    """Run logs of two folders, newest first; of two with one file name the local one counts.

    An unreadable shared log is left out, an unreadable local one is an error. Dry runs are left out
    unless asked for.
    """

    def logs(path: str, mode: str) -> DataFrame:
        schema = RUN_LOG + (", _corrupt string" if mode == "PERMISSIVE" else "")
        reader = spark.read.schema(schema).option("multiLine", "true").option("mode", mode)
        found = reader.option("columnNameOfCorruptRecord", "_corrupt").json(path).withColumn("file", F.col("_metadata.file_name"))
        return found.filter("_corrupt IS NULL").drop("_corrupt") if mode == "PERMISSIVE" else found

    out = logs(local, "FAILFAST")
    if shared is not None:
        out = out.unionByName(logs(shared, "PERMISSIVE").join(out.select("file"), "file", "left_anti"))
    if not dry_runs:
        out = out.filter(~F.coalesce("dry_run", F.lit(False)))
    return out.orderBy(F.desc("started_at"), "file")


def added_records(branches: DataFrame, main: DataFrame) -> DataFrame:
    """Rows of ``branches`` (branch, path, id, ...) whose path ``main`` lacks, with ``n``, the number
    of different ids that the branch adds. Rows without an id could not be read and are left out."""
    new = branches.filter("id IS NOT NULL").join(main.select("path").distinct(), "path", "left_anti")
    return new.join(new.groupBy("branch").agg(F.count_distinct("id").alias("n")), "branch")


def rejected_keys(listed: DataFrame, closed: DataFrame, kept: DataFrame) -> DataFrame:
    """Rejected keys in order: those of ``listed`` (ord, key), then those of closed proposals.

    ``closed`` has (ord, id, n, keys): only branches of one record count (``n`` = 1) whose id is not
    kept; an identity key counts only if no kept record (``kept``: id, keys) holds it.
    """
    single = closed.filter("n = 1").join(kept.select("id"), "id", "left_anti")
    held = kept.select(F.explode("keys").alias("key")).distinct()
    derived = single.select("ord", F.explode("keys").alias("key")).join(held, "key", "left_anti")
    ids = single.select("ord", F.col("id").alias("key"))
    places = [(listed, 0, 0), (ids, 1, 0), (derived, 1, 1)]  # of one proposal first its id, then its keys
    placed = lambda df, part, rank: df.select(F.struct(F.lit(part).alias("part"), "ord", F.lit(rank).alias("rank")).alias("at"), "key")
    every = placed(*places[0]).unionByName(placed(*places[1])).unionByName(placed(*places[2]))
    return every.groupBy("key").agg(F.min("at").alias("at")).orderBy("at", "key").select("key")


def owns(prefixes: dict[str, list[str]], routine: Column, path: Column) -> Column:
    """Whether a routine may write a state file: ``prefixes`` names the beginnings of its paths."""
    out = F.lit(False)
    for name, starts in sorted(prefixes.items()):
        for start in starts:
            out = out | ((routine == name) & path.startswith(start))
    return F.coalesce(out, F.lit(False))


def upsert(state: DataFrame, changes: DataFrame, key: str = "id", order: str = "at") -> DataFrame:
    """State with changes: the latest row of each key; a change wins a tie with the state."""
    every = state.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(order), F.desc("_new"))
    return every.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_new")


def write_records(records: DataFrame, path: str, dimensionality: str = "dimensionality", modality: str = "modality") -> None:
    """Records as Parquet in folders by dimensionality and first modality."""
    first = F.coalesce(F.try_element_at(F.col(modality), F.lit(1)), F.lit("other"))
    placed = records.withColumns({"dim_part": F.col(dimensionality), "modality_part": first})
    placed.write.mode("overwrite").partitionBy("dim_part", "modality_part").parquet(path)


def write_site(records: DataFrame, runs: DataFrame, path: str, max_runs: int = 500) -> None:
    """The dashboard's data: ``records`` and the newest ``max_runs`` runs, as JSON lines in which
    ``</`` is escaped, so that they can stand inside a page's script element."""
    safe = lambda df: df.select(F.replace(F.to_json(F.struct("*")), F.lit("</"), F.lit("<\\/")).alias("value"))
    safe(records).write.mode("overwrite").text(f"{path}/records")
    safe(runs.orderBy(F.desc("started_at")).limit(max_runs)).write.mode("overwrite").text(f"{path}/runs")
