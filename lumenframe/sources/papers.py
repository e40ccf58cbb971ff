"""Full texts of papers in JATS XML, read with Spark's XPath functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _texts(xml: Column, path: str) -> Column:
    found = F.xpath(xml, F.lit(path))
    return F.transform(found, lambda t: F.trim(F.regexp_replace(t, r"\s+", " ")))


def paper_links(papers: DataFrame, xml: str, *keep: str) -> DataFrame:
    """Links of each paper in their order (``pos`` from 0)."""
    links = F.xpath(F.col(xml), F.lit("//ext-link/@*[local-name()='href']"))
    return papers.select(*keep, F.posexplode(links).alias("pos", "href"))


def paper_parts(papers: DataFrame, xml: str, *keep: str) -> DataFrame:
    """Text nodes of each paper by kind: abstract, title, paragraph, caption, supplement.

    White space is joined; nodes of white space alone are left out. Unreadable XML is an error of
    Spark's XPath functions, so keep such rows out before; null XML has no parts.
    """
    x = F.col(xml)
    paths = {
        "abstract": "//abstract//text()",
        "title": "//sec/title//text()",
        "paragraph": "//sec/p//text()",
        "caption": "(//table-wrap|//fig)//caption//text()",
        "supplement": "//supplementary-material//text()",
    }
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), _texts(x, p).alias("texts")) for k, p in paths.items()])
    rows = papers.select(*keep, F.explode(kinds).alias("k")).select(*keep, "k.kind", F.posexplode("k.texts").alias("pos", "text"))
    return rows.filter("text <> ''")
