"""Tables with versions: immutable deltas behind a manifest, committed by compare-and-set.

Each commit writes its rows once and then creates the file of the next version, which lists the deltas that
make up the table. Only one writer can create it. A writer that began from an older version compares its keys
with what has been committed since: if they don't meet, it goes on from the newer version, else it gets
a ``Conflict`` with the rows of the other. Readers name a version or a tag and see it whatever
is written meanwhile. A row is replaced by key; a deleted one is a row with ``_deleted``.

Reading is one grouped maximum over the deltas, combined before the shuffle. ``compact`` puts a single delta in their place.
Defined results: the table of version 0 is empty; equal keys within one commit are an error;
a null key is a key of its own.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lumenframe.sources import storage


class Conflict(Exception):
    """Rows that another writer has changed since the version a commit began from."""

    def __init__(self, version: int, rows: DataFrame):
        super().__init__(f"changed since version {version}")
        self.version, self.rows = version, rows


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: str | StructType, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        plain = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.columns = plain.fieldNames()
        self.schema = StructType([*plain.fields, *StructType.fromDDL("_deleted boolean, _order long").fields])

    def _file(self, version: int) -> str:
        return f"{self.path}/versions/{version:012d}.json"

    def latest(self) -> int:
        found = [n for n in storage.names(self.spark, f"{self.path}/versions") if n.endswith(".json")]
        return int(found[-1].split(".")[0]) if found else 0

    def manifest(self, version: int) -> dict:
        return json.loads(storage.read_text(self.spark, self._file(version))) if version else {"deltas": [], "base": 0}

    def tag(self, name: str, version: int) -> bool:
        """Name a version once and for all; False if the name is taken."""
        return storage.create_once(self.spark, f"{self.path}/tags/{name}.json", json.dumps({"version": version}))

    def version_of(self, ref: int | str | None) -> int:
        if isinstance(ref, str):
            return json.loads(storage.read_text(self.spark, f"{self.path}/tags/{ref}.json"))["version"]
        return self.latest() if ref is None else ref

    def _rows(self, deltas: list[str]) -> DataFrame:
        folders = [f"{self.path}/data/{d}" for d in deltas]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def _newest(self, rows: DataFrame) -> DataFrame:
        """The newest row of each key, deleted ones too."""
        every = F.struct("_order", "_deleted", *self.columns)
        newest = rows.groupBy(F.col(self.key).alias("_key")).agg(F.max_by(every, "_order").alias("r"))
        return newest.select("r.*")

    def read(self, ref: int | str | None = None) -> DataFrame:
        """The rows of a version, a tag or, by default, the newest version."""
        rows = self._newest(self._rows(self.manifest(self.version_of(ref))["deltas"]))
        return rows.where("NOT _deleted").select(*self.columns)

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """The rows committed after a version, with ``_deleted``."""
        old = set(self.manifest(since)["deltas"])
        new = self.manifest(self.latest() if until is None else until)
        if new["base"] > since:  # compacted meanwhile: compare the contents
            before = self._newest(self._rows(sorted(old))).where("NOT _deleted").select(*self.columns)
            now = self.read(until)
            there = now.select(F.col(self.key).alias("_now"))
            gone = before.join(there, F.col(self.key).eqNullSafe(F.col("_now")), "left_anti").withColumn("_deleted", F.lit(True))
            return now.exceptAll(before).withColumn("_deleted", F.lit(False)).unionByName(gone)
        return self._newest(self._rows([d for d in new["deltas"] if d not in old])).select(*self.columns, "_deleted")

    def _write(self, rows: DataFrame, order: int) -> str:
        name = f"{order:012d}-{uuid.uuid4().hex}"
        deleted = F.coalesce("_deleted", F.lit(False)) if "_deleted" in rows.columns else F.lit(False)
        full = rows.select(*self.columns, deleted.alias("_deleted"), F.lit(order).cast("long").alias("_order"))
        full.write.parquet(f"{self.path}/data/{name}")
        return name

    def commit(self, rows: DataFrame, base: int, attempts: int = 5) -> int:
        """Put ``rows`` in, which were made from version ``base``; the new version, or a ``Conflict``."""
        if rows.groupBy(self.key).count().where("count > 1").limit(1).count():
            raise ValueError(f"equal {self.key} within one commit")
        name = self._write(rows, base + 1)
        mine = self._rows([name])
        seen = base
        for _ in range(attempts):
            newest = self.latest()
            if newest > seen:
                theirs = self.changes(base, newest)
                met = theirs.join(mine.select(F.col(self.key).alias("_mine")), F.col(self.key).eqNullSafe(F.col("_mine")), "left_semi")
                met = storage.kept(met, "conflict")
                if not met.isEmpty():
                    storage.delete(self.spark, f"{self.path}/data/{name}")
                    raise Conflict(base, met)
                moved = self._write(mine.drop("_order"), newest + 1)  # the same rows, newer than all others
                storage.delete(self.spark, f"{self.path}/data/{name}")
                name, mine, seen = moved, self._rows([moved]), newest
            before = self.manifest(newest)
            text = json.dumps({"deltas": [*before["deltas"], name], "base": before["base"]})
            if storage.create_once(self.spark, self._file(newest + 1), text):
                return newest + 1
        raise RuntimeError(f"others were faster {attempts} times")

    def compact(self) -> int:
        """A version with the same rows in one delta; older versions stay readable."""
        newest = self.latest()
        name = self._write(self.read(newest), newest)
        text = json.dumps({"deltas": [name], "base": newest + 1})
        if not storage.create_once(self.spark, self._file(newest + 1), text):
            raise RuntimeError("a commit came in between")
        return newest + 1


def move_partitions(spark: SparkSession, path: str, moved: DataFrame, key: str, by: list[str]) -> list[str]:
    """Give rows of a partitioned table their new place, and leave all other partitions' files as they are.

    ``moved``: (key, new values of the columns ``by``). Only the partitions that rows leave or enter are
    read and written again; a partition that is left empty goes. Returns the partitions written or gone,
    as ``a=x/b=y``. Rows whose place stays the same move nothing.
    """
    table = spark.read.parquet(path)
    new = moved.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_to_{c}") for c in by])
    placed = table.join(new, F.col(key) == F.col("_key"))
    differ = F.lit(False)
    for c in by:
        differ = differ | ~F.col(c).eqNullSafe(F.col(f"_to_{c}").cast(table.schema[c].dataType))
    moves = storage.kept(placed.where(differ).select("_key", *by, *[F.col(f"_to_{c}") for c in by]), "moves")
    cells = moves.select(*by).union(moves.select(*[F.col(f"_to_{c}") for c in by])).distinct()
    touched = cells.collect()  # partitions, which a file system has to list one by one as well
    if not touched:
        return []
    hit = F.lit(False)
    for cell in touched:
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.lit(cell[c]).cast(table.schema[c].dataType))
        hit = hit | same
    rows = table.where(hit).join(moves.select("_key", *[F.col(f"_to_{c}") for c in by]), F.col(key) == F.col("_key"), "left")
    kept = {c: F.when(F.col("_key").isNotNull(), F.col(f"_to_{c}").cast(table.schema[c].dataType)).otherwise(F.col(c)) for c in by}
    rows = storage.kept(rows.withColumns(kept).select(*table.columns), "moved")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    full = {tuple(r) for r in rows.select(*by).distinct().collect()}
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    names = []
    for cell in touched:
        name = "/".join(escape(c, None if cell[c] is None else str(cell[c])) for c in by)
        names.append(name)
        if tuple(cell) not in full:
            storage.delete(spark, f"{path}/{name}")
    return sorted(names)
