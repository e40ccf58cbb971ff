"""Listings, headers and metadata read out of text and bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import rollup
from lumenframe.plans import query, table
from lumenframe.sources import crawl, headers, listings, records


@query("SELECT page_id, unnest(regexp_extract_all(html, '<li><a href=\"([^\"/?#][^\"?#]*|/[^\"?#]*)\">', 1)) AS href FROM pages")
def html_links(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<li><a href="([^"?#]+)">'), F.lit(1))).alias("href"))


@query("""WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="/([^"?#/]+)">', 1)) AS name FROM pages)
SELECT page_id, name AS path, page_id * 100 + length(name) AS size, true AS exact FROM r""")
def index_listing(spark, sf):
    """Every page's menu as a preformatted index, with a size for each name."""
    names = F.regexp_extract_all("html", F.lit('<li><a href="/([^"?#/]+)">'), F.lit(1))
    page_id = F.col("page_id")
    line = lambda n: F.concat(F.lit('<a href="'), n, F.lit('">'), n, F.lit("</a> 2024-01-01 10:00 "), (page_id * 100 + F.char_length(n)).cast("string"))
    made = table(spark, sf, "pages").select("page_id", F.array_join(F.transform(names, line), "\n").alias("html"))
    return listings.index_entries(made, "html", "page_id").drop("folder")


_UNIT = "CASE l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN 'K' WHEN 2 THEN 'mb' ELSE ' G' END"


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN NULL ELSE floor(l_quantity * CASE l_linenumber % 4 WHEN 0 THEN 1 WHEN 1 THEN 1024 WHEN 2 THEN 1048576 ELSE 1073741824 END)::BIGINT END AS size,
l_returnflag <> 'N' AND l_linenumber % 4 = 0 AS exact FROM lineitem""")
def listing_sizes(spark, sf):
    text = F.when(F.col("l_returnflag") == "N", "-").otherwise(F.concat(F.col("l_quantity").cast("string"), F.expr(_UNIT)))
    found = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", listings.parse_size(text).alias("s"))
    return found.select("l_orderkey", "l_linenumber", "s.size", "s.exact")


@query("SELECT o_orderkey, 'f' || o_custkey AS path, o_orderkey * 10 AS size, o_orderkey % 2 = 0 AS more FROM orders")
def bucket_listing(spark, sf):
    """A stored answer for each order: one file, one folder, and in every second a next page."""
    xml = F.concat(
        F.lit('<ListBucketResult xmlns="urn:x"><Contents><Key>a/f'), F.col("o_custkey"), F.lit("</Key><Size>"), F.col("o_orderkey") * 10,
        F.lit("</Size></Contents><Contents><Key>a/d/</Key><Size>0</Size></Contents>"),
        F.when(F.col("o_orderkey") % 2 == 0, "<NextContinuationToken>t</NextContinuationToken>").otherwise(""), F.lit("</ListBucketResult>"),
    )
    answers = table(spark, sf, "orders").select("o_orderkey", xml.alias("xml"))
    return listings.bucket_entries(answers, "xml", F.lit("a/"), "o_orderkey").drop("exact")


@query("""SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'html' WHEN page_id % 4 = 1 THEN 'png' WHEN page_id % 4 = 2 THEN 'nifti-gz' END AS format, CASE WHEN page_id % 4 = 1 THEN page_id END AS width FROM pages""")
def magic_sniff(spark, sf):
    k = F.col("page_id") % 4
    png = F.concat(F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), F.unhex(F.lpad(F.hex("page_id"), 8, "0")), F.unhex(F.lit("00000005")))
    content = F.when(k == 0, F.encode("html", "UTF-8")).when(k == 1, png).otherwise(F.encode(F.lit("x"), "UTF-8"))
    name = F.when(k == 2, "a.nii.gz").otherwise("b.bin")
    return table(spark, sf, "pages").select("page_id", headers.sniff(name, content).alias("format"), headers.png_size(content)["width"].alias("width"))


@query("SELECT p_partkey, p_size::BIGINT AS depth, round(p_retailprice * 1000, 4) AS x_nm, 2 AS levels FROM part")
def multiscale_metadata(spark, sf):
    """A multiscale group for each part, with micrometres along x."""
    json = F.format_string(
        '{"ome":{"multiscales":[{"axes":[{"name":"z","unit":"nanometer"},{"name":"x","unit":"micrometer"}],"datasets":[{"path":"0","coordinateTransformations":[{"type":"scale","scale":[2.0,%s]}]},{"path":"1"}]}]},"zarr_format":3,"shape":[%d,7],"data_type":"uint8"}',
        F.col("p_retailprice").cast("string"), "p_size",
    )
    found = table(spark, sf, "part").select("p_partkey", headers.ome_scale(json).alias("o"), headers.zarr_array(json).alias("a"))
    return found.select("p_partkey", F.get("a.shape", F.lit(0)).alias("depth"), F.col("o.voxel_size_nm.x").alias("x_nm"), F.col("o.levels").alias("levels"))


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_attributes(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority LIKE '1%' WHEN o_orderstatus = 'O' THEN o_orderpriority LIKE '2%' OR o_orderpriority LIKE '3%' ELSE false END AS owned FROM orders""")
def state_ownership(spark, sf):
    owned = records.owns({"F": ["1"], "O": ["2", "3"]}, F.col("o_orderstatus"), F.col("o_orderpriority"))
    return table(spark, sf, "orders").select("o_orderkey", owned.alias("owned"))


@query("""WITH s AS (SELECT user_id AS branch, event_type AS path, event_id AS id FROM events WHERE value > 1), n AS (SELECT * FROM s WHERE path NOT IN ('click', 'view'))
SELECT branch, path, id, n FROM n JOIN (SELECT branch, count(DISTINCT id) AS n FROM n GROUP BY 1) USING (branch)""")
def branch_additions(spark, sf):
    e = table(spark, sf, "events").filter("value > 1").selectExpr("user_id AS branch", "event_type AS path", "event_id AS id")
    main = table(spark, sf, "events").filter("event_type IN ('click', 'view')").selectExpr("event_type AS path")
    return records.added_records(e, main)


@query("""WITH RECURSIVE n AS (SELECT page_id, page_id // 40 AS r, page_id % 40 AS j FROM pages),
w AS (SELECT r, j, 0 AS depth, 'http://x.org/' || r || '/' AS url FROM n WHERE j = 0
 UNION ALL SELECT w.r, n.j, depth + 1, w.url || 'd' || n.j || '/' FROM w JOIN n ON n.r = w.r AND n.j > 0 AND (n.j - 1) // 3 = w.j WHERE w.r % 5 > 0 OR w.j % 9 <> 8),
o AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY depth, url) AS rank, r % 5 > 0 OR j % 9 <> 8 AS answered FROM w),
k AS (SELECT * FROM o WHERE rank <= 25),
s AS (SELECT r, count(*) AS n_dirs, 2 * count(*) FILTER (answered) + count(*) FILTER (answered AND j % 4 = 1) AS n_files, count(*) FILTER (NOT answered) > 0 AS silent FROM k GROUP BY r)
SELECT 'http://x.org/' || s.r || '/' AS root, n_dirs, n_files, concat_ws('; ', CASE WHEN (SELECT count(*) FROM o WHERE o.r = s.r) > 25 THEN 'budget of folders or files' END, CASE WHEN silent THEN 'no answer from a folder' END) AS problems,
 (SELECT sum(page_id)::BIGINT FROM k JOIN n ON n.r = k.r AND n.j = k.j WHERE k.r = s.r AND answered) AS bytes FROM s""")
def crawl_listing(spark, sf):
    """Trees of forty folders, made from pages: index pages with two files each, some continued on a second page, some missing."""
    k, below = F.col("page_id"), F.col("page_id") % 40
    pages = table(spark, sf, "pages").select("page_id")
    root = F.concat(F.lit("http://x.org/"), F.floor(k / 40), F.lit("/"))
    # the folders from the root to a page, by its number in the tree
    up = F.aggregate(
        F.sequence(F.lit(1), F.lit(4)), F.struct(below.alias("j"), F.lit("").alias("path")),
        lambda s, _: F.when(s["j"] > 0, F.struct(F.floor((s["j"] - 1) / 3).alias("j"), F.concat(F.lit("d"), s["j"], F.lit("/"), s["path"]).alias("path"))).otherwise(s),
    )["path"]
    url = F.concat(root, up)
    entry = lambda name, size, folder: F.struct(name.alias("name"), size.cast("long").alias("size"), F.lit(folder).alias("folder"))
    last = pages.groupBy(F.floor(k / 40).alias("tree")).agg(F.max(below).alias("last"))
    known = pages.join(last, F.floor(k / 40) == F.col("tree"))
    children = F.filter(F.sequence(below * 3 + 1, below * 3 + 3), lambda c: c <= F.col("last"))
    folders = F.transform(children, lambda c: entry(F.concat(F.lit("d"), c, F.lit("/")), F.lit(None), True))
    own = F.array(entry(F.lit("a.tif"), k, False), entry(F.lit("b.tif"), F.lit(0), False), entry(F.lit("../"), F.lit(None), True))
    more = below % 4 == 1
    first = known.select(url.alias("url"), F.concat(own, folders).alias("entries"), F.when(more, F.concat(url, F.lit("?page=2"))).alias("next"), below.alias("j"), F.col("tree"))
    second = first.where("next IS NOT NULL").select(F.col("next").alias("url"), F.array(entry(F.lit("c.tif"), F.lit(0), False)).alias("entries"), F.lit(None).cast("string").alias("next"), "j", "tree")
    answers = first.unionByName(second).where("tree % 5 > 0 OR j % 9 <> 8").drop("j", "tree")
    files, summary = crawl.crawl(pages.where(below == 0).select(root.alias("root")), answers, max_dirs=25)
    size = files.groupBy("root").agg(F.sum("size").alias("bytes"))
    return summary.join(size, "root", "left").select("root", "n_dirs", "n_files", F.array_join("problems", "; ").alias("problems"), "bytes")


@query("""WITH f AS (SELECT 'l' || (l_orderkey % 20) AS listing, l_linenumber % 4 AS kind, l_partkey % 5 AS n, l_orderkey % 20 = 7 AS junk, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity::BIGINT END AS size FROM lineitem),
k AS (SELECT listing, CASE kind WHEN 0 THEN 'img_#' WHEN 1 THEN 'vol_' || n || '.zarr' ELSE '' END AS dir, CASE kind WHEN 0 THEN 'ome.tif' WHEN 1 THEN 'zarr' ELSE 'txt' END AS ext, n, kind, size FROM f WHERE kind <> 2 AND NOT junk),
h AS (SELECT listing, count(*) FILTER (kind = 2 OR junk) AS hidden FROM f GROUP BY listing),
g AS (SELECT listing, CASE kind WHEN 1 THEN 'vol_#.zarr' ELSE dir END AS dir, ext, count(*) AS n_files, coalesce(sum(size), 0)::BIGINT AS bytes, bool_or(size IS NULL) AS any_unknown, count(DISTINCT CASE WHEN kind < 2 THEN n ELSE 0 END) AS n_dirs FROM k GROUP BY ALL)
SELECT h.listing, CASE WHEN dir IS NULL THEN NULL ELSE 'data/v1' END AS prefix, dir, n_files, bytes, any_unknown, n_dirs, '.' || ext || ' ' || n_files AS extensions, hidden FROM h LEFT JOIN g ON g.listing = h.listing""")
def directory_tree(spark, sf):
    """Listings of made paths: numbered siblings, chunk stores, junk and a common folder."""
    kind, n, order = F.col("l_linenumber") % 4, (F.col("l_partkey") % 5).cast("string"), F.col("l_orderkey")
    tail = (
        F.when(kind == 0, F.concat(F.lit("img_"), n, F.lit("/A"), order, F.lit(".OME.tif")))
        .when(kind == 1, F.concat(F.lit("vol_"), n, F.lit(".zarr/c/"), order, F.lit("/0"))).when(kind == 2, F.concat(F.lit(".git/"), order)).otherwise("notes.txt")
    )
    path = F.when(order % 20 == 7, F.concat(F.lit("x/._"), order)).otherwise(F.concat(F.lit("data/v1/"), tail))
    size = F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_quantity").cast("long"))
    files = table(spark, sf, "lineitem").select(F.concat(F.lit("l"), order % 20).alias("listing"), path.alias("path"), size.alias("size"))
    return rollup.directory_tree(files, "listing")
