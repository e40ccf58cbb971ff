"""Identity keys, uniqueness, candidate classification and fuzzy titles."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lumenframe.functions.rules import reasons
from lumenframe.functions.text import title_normalize, url_normalize
from lumenframe.operators.ranking import ranked


def identity_keys(doi: Column, repository: Column, accession: Column, landing_url: Column) -> Column:
    """Keys of a record, strongest first; the landing page only where there is no other."""
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    strong = F.filter(
        F.array(
            F.when(some(doi), F.concat(F.lit("doi:"), F.lower(doi))),
            F.when(some(accession), F.concat(F.lit("acc:"), F.lower(F.coalesce(repository, F.lit(""))), F.lit(":"), F.lower(accession))),
        ),
        lambda k: k.isNotNull(),
    )
    page = F.when(some(landing_url), F.array(F.concat(F.lit("url:"), url_normalize(landing_url))))
    return F.when(F.size(strong) > 0, strong).otherwise(F.coalesce(page, F.array().cast("array<string>")))


def shared_keys(keys: DataFrame) -> DataFrame:
    """(key, first_ord, ord) of rows whose key an earlier row has; keys: (key, ord).

    The first row of a key is a grouped minimum and joined back, so a key that a third of all rows
    share is not sorted in one task.
    """
    first = keys.groupBy("key").agg(F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return keys.join(first.drop("n"), "key").where(F.col("ord") > F.col("first_ord")).select("key", "first_ord", "ord")


def classify(candidates: DataFrame, rejected: DataFrame, pending: DataFrame, catalog: DataFrame, possible: DataFrame) -> DataFrame:
    """(id, status): the first that holds of rejected, pending, duplicate, possible-duplicate, new.

    candidates: (id, key); rejected, pending, catalog: (key); possible: (id). Each list is reduced to its
    distinct keys before the join.
    """
    found = candidates.select("id").distinct()
    for rank, (name, keys) in enumerate((("rejected", rejected), ("pending", pending), ("duplicate", catalog))):
        hit = candidates.join(keys.select("key").distinct(), "key", "left_semi").select("id").distinct()
        found = found.join(hit.withColumn(f"r{rank}", F.lit(name)), "id", "left")
    found = found.join(possible.select("id").distinct().withColumn("r3", F.lit("possible-duplicate")), "id", "left")
    return found.select("id", F.coalesce("r0", "r1", "r2", "r3", F.lit("new")).alias("status"))


def rest_overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of the words of two titles after their common leading words; both empty: 1."""
    wa, wb = F.split(a, " "), F.split(b, " ")
    least = F.least(F.size(wa), F.size(wb))
    same = F.aggregate(
        F.sequence(F.lit(1), least),
        F.lit(0),
        lambda n, i: F.when((n == i - 1) & (F.get(wa, i - 1) == F.get(wb, i - 1)), i).otherwise(n),
    )
    ra = F.array_distinct(F.slice(wa, same + 1, F.size(wa)))
    rb = F.array_distinct(F.slice(wb, same + 1, F.size(wb)))
    both = F.size(F.array_union(ra, rb))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(ra, rb)) / both)


@F.pandas_udf(DoubleType())
def match_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio; the order of the arguments matters."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


def letter_counts(text: Column) -> Column:
    """How often each of a-z, 0-9 and the space occurs, for an upper bound of the ratio."""
    return F.array(*[F.char_length(text) - F.char_length(F.replace(text, F.lit(c))) for c in "abcdefghijklmnopqrstuvwxyz0123456789 "])


def fuzzy_titles(rows: DataFrame, id_col: str, title_col: str, ratio: float = 0.92) -> DataFrame:
    """(a, b, ratio), a < b: pairs of rows with different normalized titles of at least this ratio.

    Lossless blocking. With m matched characters the ratio is 2m / (la + lb), so a pair needs
    lengths near each other, and at most la - m characters of either side are not matched; m falls
    into at most (unmatched of both + 1) runs. Cutting the shorter title into more pieces than that
    leaves one piece untouched in the other one: pieces of all titles are joined with the substrings
    of the same length class, then length and letter bounds, then the ratio itself.
    Equal titles are one representative; their rows come back through ``members``.
    """
    t = rows.select(F.col(id_col).alias("id"), title_normalize(F.col(title_col)).alias("t")).where("t <> ''")
    one = t.groupBy("t").agg(F.min("id").alias("id"))
    one = one.withColumn("l", F.char_length("t"))
    slack = (1 - ratio) / ratio  # unmatched characters of a side, as a share of the matched ones
    # a pair of lengths l1 <= l2 has at most l1 + l2 - 2m unmatched, m >= ratio (l1 + l2) / 2
    parts = F.floor(F.col("l") * F.lit(2 * slack) * F.lit(1 + slack)).cast("int") + 2
    size = F.greatest(F.lit(1), F.floor(F.col("l") / parts).cast("int"))
    piece = one.select("id", "t", "l", size.alias("size"), F.explode(F.sequence(F.lit(0), F.floor(F.col("l") / size).cast("int") - 1)).alias("k"))
    piece = piece.select("id", "t", "l", "size", F.substring("t", F.col("k") * F.col("size") + 1, F.col("size")).alias("gram"))
    low, high = F.ceil(F.col("l") * F.lit(ratio / (2 - ratio))).cast("int"), F.floor(F.col("l") * F.lit((2 - ratio) / ratio)).cast("int")
    lengths = one.select("l").distinct().select(F.col("l").alias("pl"))
    sizes = lengths.select("pl", F.greatest(F.lit(1), F.floor(F.col("pl") / (F.floor(F.col("pl") * F.lit(2 * slack) * F.lit(1 + slack)).cast("int") + 2)).cast("int")).alias("size"))
    spans = one.select("id", "t", "l", F.explode(F.sequence(low, high)).alias("pl")).join(F.broadcast(sizes), "pl")
    spans = spans.select("id", "t", "l", "size").distinct()
    gram = spans.select("id", "t", "l", "size", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("l") - F.col("size") + 1))).alias("p"))
    gram = gram.select(F.col("id").alias("id2"), F.col("t").alias("t2"), F.col("l").alias("l2"), "size", F.substring("t", F.col("p"), F.col("size")).alias("gram")).distinct()
    near = piece.distinct().join(gram, ["size", "gram"]).where(F.col("id") != F.col("id2"))
    near = near.where(2.0 * F.least("l", "l2") / (F.col("l") + F.col("l2")) >= ratio)
    a_first = F.col("id") < F.col("id2")
    pair = near.select(
        F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"),
        F.when(a_first, F.col("t")).otherwise(F.col("t2")).alias("ta"), F.when(a_first, F.col("t2")).otherwise(F.col("t")).alias("tb"),
    ).distinct()
    shared = F.aggregate(F.zip_with(letter_counts(F.col("ta")), letter_counts(F.col("tb")), lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    pair = pair.where(2.0 * shared / (F.char_length("ta") + F.char_length("tb")) >= ratio)
    return pair.withColumn("ratio", match_ratio("ta", "tb")).where(F.col("ratio") >= ratio).select("a", "b", "ratio")


def title_members(rows: DataFrame, id_col: str, title_col: str) -> DataFrame:
    """(id, representative): rows with equal normalized titles share the smallest id."""
    t = rows.select(F.col(id_col).alias("id"), title_normalize(F.col(title_col)).alias("t")).where("t <> ''")
    return t.join(t.groupBy("t").agg(F.min("id").alias("representative")), "t").select("id", "representative")


def similarity_reasons(a: Column, b: Column, ratio: float = 0.92, rest: float = 0.5, versioned: str = "Zenodo") -> Column:
    """Why two records are likely one dataset, as an array of texts, empty if nothing says so.

    Records are structs: download_url, title, repository, ids (strong identity keys), dois. The same
    download counts always. If both have ids and share none they are different, but for equal titles in the
    repository that gives each version an id; else a title of at least ``ratio``, or the same paper and titles
    whose words after their common beginning overlap by ``rest``.
    """
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    ta, tb = title_normalize(a["title"]), title_normalize(b["title"])
    known = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    ids = [known(x["ids"]) for x in (a, b)]
    apart = (F.size(ids[0]) > 0) & (F.size(ids[1]) > 0) & ~F.arrays_overlap(*ids)
    papers = F.array_sort(F.array_intersect(*[F.transform(known(x["dois"]), F.lower) for x in (a, b)]))
    alike = match_ratio(ta, tb)
    titles = (ta != "") & (tb != "") & ~apart
    version = apart & (ta != "") & (ta == tb) & (a["repository"] == versioned) & (b["repository"] == versioned)
    paper = titles & (alike < ratio) & (F.size(papers) > 0) & (rest_overlap(ta, tb) >= rest)
    return reasons(
        (some(a["download_url"]) & some(b["download_url"]) & (url_normalize(a["download_url"]) == url_normalize(b["download_url"])), "same download URL"),
        (version, F.concat(F.lit("same title on "), F.lit(versioned), F.lit(" (another version?)"))),
        (titles & (alike >= ratio), F.concat(F.lit("title "), F.format_string("%.0f", F.bround(alike * 100, 0)), F.lit("% similar"))),
        (paper, F.concat(F.lit("same paper ("), F.array_join(papers, ", "), F.lit(") and similar title"))),
    )


def similar_records(catalog: DataFrame, id_col: str = "id", ratio: float = 0.92, **knobs) -> DataFrame:
    """(a, b, reasons), a < b: pairs of catalog records that ``similarity_reasons`` links, ``a`` the smaller id.

    No pair is made but those that a reason can hold for: equal download, equal title, a shared paper (joins
    on the value) or a similar title (``fuzzy_titles``). Of a value's records each is paired with all others,
    which is the result asked for.
    """
    record = F.struct(*[F.col(c) for c in ("download_url", "title", "repository", "ids", "dois")])
    rows = catalog.select(F.col(id_col).alias("id"), record.alias("r"))
    values = rows.select(
        "id",
        F.explode(
            F.array_distinct(
                F.filter(
                    F.concat(
                        F.array(F.concat(F.lit("u"), url_normalize(F.col("r.download_url")))),
                        F.array(F.when(title_normalize(F.col("r.title")) != "", F.concat(F.lit("t"), title_normalize(F.col("r.title"))))),
                        F.transform(F.coalesce("r.dois", F.array().cast("array<string>")), lambda d: F.concat(F.lit("d"), F.lower(d))),
                    ),
                    lambda v: v.isNotNull(),
                )
            )
        ).alias("v"),
    )
    equal = values.alias("x").join(values.alias("y"), "v").where(F.col("x.id") < F.col("y.id")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    members = title_members(rows.select("id", F.col("r.title").alias("title")), "id", "title")
    near = fuzzy_titles(rows.select("id", F.col("r.title").alias("title")), "id", "title", ratio)
    left, right = (members.select(F.col("id").alias(n), F.col("representative").alias(k)) for n, k in (("m", "a"), ("n", "b")))
    near = near.join(left, "a").join(right, "b").select(F.least("m", "n").alias("a"), F.greatest("m", "n").alias("b"))
    pairs = equal.union(near).distinct()
    full = pairs.join(rows.select(F.col("id").alias("a"), F.col("r").alias("ra")), "a").join(rows.select(F.col("id").alias("b"), F.col("r").alias("rb")), "b")
    found = full.withColumn("reasons", similarity_reasons(F.col("ra"), F.col("rb"), ratio, **knobs))
    return found.where(F.size("reasons") > 0).select("a", "b", "reasons")


def numbered(known: DataFrame, wanted: DataFrame) -> DataFrame:
    """(ord, files, name): the known name of a file set, else the next free number in the order of ``ord``.

    known: (files array, name like crop-007); wanted: (ord, files array).
    """
    top = known.agg(F.coalesce(F.max(F.regexp_extract("name", r"(\d+)$", 1).cast("int")), F.lit(0)).alias("top")).withColumn("one", F.lit(1))
    k = known.select(F.sort_array("files").alias("files"), "name")
    w = wanted.select("ord", F.sort_array("files").alias("files")).join(k, "files", "left").withColumn("one", F.lit(1)).join(F.broadcast(top), "one")
    new = ranked(w.where(F.col("name").isNull()), F.col("ord"), "ord")
    new = new.select("ord", "files", F.format_string("crop-%03d", (F.col("top") + F.col("rank") + 1).cast("int")).alias("name"))
    return w.where(F.col("name").isNotNull()).select("ord", "files", "name").unionByName(new)
