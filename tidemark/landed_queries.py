"""Driver queries that land files made of the driver's tables, and run readers, extractors, syncs and sinks over them.

Pages are numbered folders (``page=<n>``), so that their order as text differs
from their order as numbers from the tenth on; a row that comes again on the
next page shows which of the two wins.  Suppliers stand in for members, parts
for posts, orders for groups, events for messages.
"""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import filters, joins, membership, stats
from tidemark.plans import blogs as archive
from tidemark.plans.sync import sync
from tidemark.queries import _RAW, _SUBSCRIPTION, _TYPE, _groups, _messages, _sql_ts, _table, _ts, query
from tidemark.sinks import export
from tidemark.sinks.shared import by_page, few_listings, land, new_folder
from tidemark.sinks.store import Store
from tidemark.sources import files, html, jsonp, landed, media, scan, schemas
from tidemark.streaming import member_state
from tidemark.streaming.sync_stream import page_stream, start

BASE = "https://x.example"
_BROKEN = "{not json"


def _list(item: Column) -> Column:
    """The items of a group in the order of their first field."""
    return F.array_sort(F.collect_list(item))


def _envelopes(rows: DataFrame, key: str) -> DataFrame:
    """(page, value) of rows (page, item)."""
    return by_page(rows).groupBy("page").agg(F.to_json(F.struct(_list(F.col("item")).alias(key))).alias("value"))


def _twice(rows: DataFrame, per_page: int) -> DataFrame:
    """``rows`` (id, ...) on their page as ``copy`` 1 and again on the next one as 2."""
    first = rows.withColumn("page", F.floor(F.col("id") / per_page))
    return first.withColumn("copy", F.lit(1)).unionByName(first.withColumn("page", F.col("page") + 1).withColumn("copy", F.lit(2)))


def _with_broken(pages: DataFrame, value: str = _BROKEN) -> DataFrame:
    broken = pages.sparkSession.range(1).select(F.lit(10_000_000).cast("long").alias("page"), F.lit(value).alias("value"))
    return pages.select(F.col("page").cast("long"), "value").unionByName(broken)


@query("SELECT event_id AS id, user_id AS member_id, 'copy 2' AS text FROM events")
def landed_timeline(spark, sf_dir):
    """Every message lies on two pages, the later one wins."""
    rows = _twice(_messages(spark, sf_dir).select("id", "member_id"), 500)
    item = F.struct("id", "member_id", F.concat(F.lit("copy "), F.col("copy").cast("string")).alias("text"))
    path = land(_with_broken(_envelopes(rows.select("page", item.alias("item")), "messages")), "timeline")
    return landed.timeline(spark, path).select("id", "member_id", "text")


@query(f"SELECT 'visible' AS kind, o_orderkey AS id FROM orders WHERE o_orderstatus = 'F' OR coalesce({_SUBSCRIPTION} = 'active', false) UNION ALL SELECT 'any', o_orderkey FROM orders WHERE o_orderstatus = 'F' OR {_SUBSCRIPTION} IS NOT NULL")
def landed_groups(spark, sf_dir):
    """S2 with P1."""
    rows = _groups(spark, sf_dir).select(F.floor(F.col("id") / 2000).alias("page"), F.struct("id", "state", F.struct(F.col("subscription").alias("state")).alias("subscription")).alias("item"))
    path = land(by_page(rows).groupBy("page").agg(F.to_json(_list(F.col("item"))).alias("value")), "groups")
    return landed.groups(spark, path).select(F.lit("visible").alias("kind"), "id").unionByName(landed.groups(spark, path, True).select(F.lit("any").alias("kind"), "id"))


@query("SELECT s_suppkey AS id, s_name AS name, 'p' || s_nationkey AS portrait FROM supplier")
def landed_members(spark, sf_dir):
    """S3."""
    item = F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("p"), F.col("s_nationkey").cast("string")).alias("portrait"))
    rows = _table(spark, sf_dir, "supplier").select(F.floor(F.col("s_suppkey") / 40).alias("page"), item.alias("item"))
    path = land(rows.groupBy("page").agg(F.to_json(_list(F.col("item"))).alias("value")), "members")
    return landed.members(spark, path).select("id", "name", "portrait")


@query("""
SELECT 'past_messages' AS reader, n_nationkey AS id FROM nation UNION ALL SELECT 'tags', n_nationkey FROM nation UNION ALL SELECT 'organizations', n_nationkey FROM nation
UNION ALL SELECT * FROM (SELECT 'letters', n_nationkey FROM nation WHERE n_nationkey >= 4 ORDER BY n_nationkey LIMIT 15)
UNION ALL SELECT * FROM (SELECT 'news', n_nationkey FROM nation ORDER BY n_nationkey LIMIT 20)
UNION ALL SELECT 'fc_contents', n_nationkey FROM nation WHERE n_nationkey % 3 = 1
UNION ALL SELECT 'products', n_nationkey FROM nation WHERE n_regionkey = 2 UNION ALL SELECT 'single', min(n_nationkey) FROM nation
""")
def landed_envelopes(spark, sf_dir):
    """The readers of envelopes and of one object; letters and news take the first ones in page order."""
    nation = _table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    updated = F.concat(F.lit("2024-01-"), F.lpad((key + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z"))
    item = F.struct(key.alias("id"), updated.alias("updated_at"), (key % 3).alias("organization_id"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("type"))
    rows = nation.select(F.floor(key / 2).alias("page"), item.alias("item"))  # thirteen pages
    at = {name: land(_envelopes(rows, name), name) for name in ("messages", "letters", "announcements", "tags", "contents", "organizations", "products")}
    one = nation.agg(F.min("n_nationkey").alias("id")).select(F.lit(0).alias("page"), F.to_json(F.struct("id")).alias("value"))
    found = {
        "past_messages": landed.past_messages(spark, at["messages"]),
        "letters": landed.letters(spark, at["letters"], "2024-01-05T00:00:00Z", 15),
        "news": landed.news(spark, at["announcements"]),
        "tags": landed.tags(spark, at["tags"]),
        "fc_contents": landed.fc_contents(spark, at["contents"], 1),
        "organizations": landed.organizations(spark, at["organizations"]),
        "products": landed.products(spark, at["products"], "r2"),
        "single": landed.single(spark, land(one, "single")),
    }
    out = None
    for name, rows in found.items():
        part = rows.select(F.lit(name).alias("reader"), F.get_json_object("raw", "$.id").cast("long").alias("id"))
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT CASE WHEN n_nationkey % 3 = 0 THEN 'corrupt' ELSE 'stored' END AS kind, n_nationkey AS id, CASE WHEN n_nationkey % 3 > 0 THEN 2 END AS n FROM nation")
def stored_documents(spark, sf_dir):
    """S28 and ``corrupt``: a third of the stored member documents are cut off."""
    key = F.col("n_nationkey")
    whole = F.to_json(F.struct(F.struct(key.alias("id"), F.col("n_name").alias("name")).alias("member"), F.array(F.struct(key.alias("id")), F.struct((key + 1).alias("id"))).alias("messages")))
    pages = _table(spark, sf_dir, "nation").select(key.alias("page"), F.when(key % 3 == 0, F.substring(whole, 1, 9)).otherwise(whole).alias("value"))
    path = land(pages, "documents")
    good, bad = landed.documents(spark, path)
    number = F.regexp_extract("page", r"page=(\d+)", 1).cast("long")
    shown = good.select(F.lit("stored").alias("kind"), F.col("member.id").alias("id"), F.size("messages").alias("n"))
    same = bad.join(landed.corrupt(spark, path), "page").select(F.lit("corrupt").alias("kind"), number.alias("id"), F.lit(None).cast("int").alias("n"))
    return shown.unionByName(same)


@query("SELECT 1 AS group_id, user_id AS member_id, max(event_id) AS last_message_id, count(*) AS total_messages FROM events GROUP BY user_id")
def state_file(spark, sf_dir):
    """The state of all members from its one file."""
    report = stats.member_report(filters.normalize(_messages(spark, sf_dir)), ["member_id"])
    entry = F.struct(F.concat(F.lit("1_"), F.col("member_id").cast("string")).alias("key"), F.struct("last_message_id", F.lit("2024").alias("last_sync_ts"), "total_messages").alias("value"))
    page = report.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")).withColumn("page", F.lit(0))
    return landed.sync_state(spark, land(page, "state")).select("group_id", "member_id", "last_message_id", "total_messages")


def _text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _pages(rows: DataFrame, markup: Column, per_page: int, id_: str = "id") -> DataFrame:
    """(page, value): the markup of all rows of a page in the order of their ids."""
    placed = rows if "page" in rows.columns else rows.withColumn("page", F.floor(F.col(id_) / per_page))
    return by_page(placed).groupBy("page").agg(F.array_join(F.transform(_list(F.struct(F.col(id_), markup.alias("m"))), lambda x: x["m"]), "").alias("value"))


def _suppliers(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))


@query("SELECT 'A' AS site, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name FROM supplier UNION ALL SELECT 'C', CAST(s_suppkey AS VARCHAR), s_name FROM supplier")
def html_members(spark, sf_dir):
    """Names in the link or beside it; the group's own account is left out."""
    rows, key = _suppliers(spark, sf_dir), F.col("id")
    named = F.when(key % 2 == 0, _text('<div><a href="/list?ct=', key, '">', F.col("name"), "</a></div>")).otherwise(_text('<div><a href="/list?ct=', key, '"></a><p class="name">', F.col("name"), "</p></div>"))
    account = _text(f'<a href="?ct=99999999">{html.GROUP_ACCOUNTS["A"][0]}</a>')
    diary = land(_pages(rows, F.concat(named, account), 30), "diary")
    artists = land(_pages(rows, _text('<a href="/s/s46/artist/', key, '"><img src="/i.jpg"><div>', F.col("name"), "</div><div>x</div></a>"), 30), "artists")
    found = {"A": html.members(html.pages(spark, diary), html.site("A", BASE)), "C": html.members(html.pages(spark, artists), html.site("C", BASE))}
    return found["A"].select(F.lit("A").alias("site"), "id", "name").unionByName(found["C"].select(F.lit("C").alias("site"), "id", "name"))


@query(f"SELECT 'A' AS site, CAST(s_suppkey AS VARCHAR) AS id, '{BASE}/' || CASE WHEN s_suppkey % 3 = 0 THEN 'd/' ELSE '' END || s_suppkey || '.jpg' AS thumbnail_url FROM supplier UNION ALL SELECT 'C', CAST(s_suppkey AS VARCHAR), '{BASE}/' || s_suppkey || '.jpg' FROM supplier")
def html_member_images(spark, sf_dir):
    """Images of the artist page, and of the diary page where it has none."""
    rows, key = _suppliers(spark, sf_dir), F.col("id")
    image = F.when(key % 3 == 0, F.lit("")).otherwise(_text('<img src="/', key, '.jpg">'))
    artists = land(_pages(rows, _text('<ul><li><a href="/artist/', key, '">', image, "<p>", F.col("name"), "</p></a></li></ul>"), 30), "artists")
    diary = land(_pages(rows, _text('<div><a href="?ct=', key, '"><img src="/d/', key, '.jpg"><span class="p-blog-member__name">', F.col("name"), "</span></a></div>"), 30), "diary")
    others = land(_pages(rows, _text('<a href="/s/s46/artist/', key, '"><img src="/', key, '.jpg" alt="a"><div>', F.col("name"), "</div></a>"), 30), "others")
    a = html.member_images(html.pages(spark, artists), html.site("A", BASE), html.pages(spark, diary))
    c = html.member_images(html.pages(spark, others), html.site("C", BASE))
    return a.select(F.lit("A").alias("site"), "id", "thumbnail_url").unionByName(c.select(F.lit("C").alias("site"), "id", "thumbnail_url"))


def _posts(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("name"), (F.col("p_size") % 28 + 1).alias("day"))


_DAY = "(p_size % 28 + 1)"
_A_ITEM = ('<article class="p-blog-article"><a href="/s/diary/detail/', "id", '"><div class="c-blog-article__title">', "title", '</div><div class="c-blog-article__date">2024.1.', "day", ' 10:00</div><div class="c-blog-article__name">', "name", '</div><img src="/', "id", '.jpg"></a></article>')
_C_ITEM = ('<li class="box"><a href="/s/s46/diary/detail/', "id", '"><span class="img" style="background-image: url(\'/', "id", '.jpg\')"></span><p class="date">2024/1/', "day", ' 10:00</p><h3>', "title", '</h3><p class="name">', "name", "</p></a></li>")


def _filled(parts: tuple, columns: tuple = ("id", "title", "day", "name")) -> Column:
    return F.concat(*(F.col(p).cast("string") if p in columns else F.lit(p) for p in parts))


def _lists(spark, sf_dir, item: tuple, name: str) -> DataFrame:
    """List pages on which every post comes again on the next one, with another title."""
    rows = _twice(_posts(spark, sf_dir), 100).withColumn("title", F.when(F.col("copy") == 1, F.col("title")).otherwise("again"))
    return html.pages(spark, land(_pages(rows, _filled(item), 100), name))


@query(f"SELECT site, CAST(p_partkey AS VARCHAR) AS id, p_name AS title, {_sql_ts(f'make_timestamp(2024, 1, CAST({_DAY} AS BIGINT), 1, 0, 0.0)')} AS published_at, p_brand AS member_name, '{BASE}/' || p_partkey || '.jpg' AS image, '{BASE}/diary/detail/' || p_partkey AS url FROM part, (VALUES ('A'), ('C')) AS s(site)")
def html_lists(spark, sf_dir):
    """Posts of list pages; the first of two wins."""
    out = None
    for name, item in (("A", _A_ITEM), ("C", _C_ITEM)):
        found = html.blog_list(_lists(spark, sf_dir, item, f"list-{name}"), html.site(name, BASE))
        part = found.select(F.lit(name).alias("site"), "id", "title", F.date_format(F.to_utc_timestamp("published_at", F.current_timezone()), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("published_at"), "member_name", F.get("images", F.lit(0)).alias("image"), "url")
        out = part if out is None else out.unionByName(part)
    return out


_STATUS = "CASE p_partkey % 10 WHEN 0 THEN 'gone' WHEN 1 THEN 'error' ELSE 'ok' END"


def _details(spark, sf_dir, site: str) -> DataFrame:
    """(id, status, html): of ten posts one is gone and one failed."""
    body = ("Shows &lt;b&gt; &amp; <b title=\"a &quot;b&quot;\">", "title", '</b><br><img src="/', "id", '.jpg">')
    a = ('<div class="c-blog-article__title"> ', "title", ' </div><div class="c-blog-article__date"><time>2024.1.', "day", ' 10:00</time></div><div class="c-blog-article__name"><a href="?ct=40">', "name", '</a></div><div class="c-blog-article__text">', *body, "</div>")
    c = ('<meta property="og:title" content="', "title", ' | Site"><div class="box-article">', *body, '</div><div class="blog-foot"><p class="date">2024/01/', "day", " 10:00</p></div>")
    status = F.when(F.col("id") % 10 == 0, 404).when(F.col("id") % 10 == 1, 500).otherwise(200)
    return _posts(spark, sf_dir).select(F.col("id").cast("string").alias("id"), status.alias("status"), F.when(status == 200, _filled(a if site == "A" else c)).alias("html"))


@query(f"""
SELECT site, CAST(p_partkey AS VARCHAR) AS id, {_STATUS} AS outcome, CASE WHEN p_partkey % 10 > 1 THEN p_name END AS title,
  CASE WHEN p_partkey % 10 > 1 THEN 'Shows &lt;b&gt; &amp; <b title=''a "b"''>' || p_name || '</b><br/><img src="{BASE}/' || p_partkey || '.jpg"/>' END AS content,
  CASE WHEN p_partkey % 10 > 1 THEN '{BASE}/' || p_partkey || '.jpg' END AS image
FROM part, (VALUES ('A'), ('C')) AS s(site)""")
def html_details(spark, sf_dir):
    """Content is escaped as it was, and its images are found; gone and failed pages keep their outcome."""
    out = None
    for name in ("A", "C"):
        rows, where = _details(spark, sf_dir, name), html.site(name, BASE)
        found = html.blog_details(rows, where)
        known = html.metadata_of(found, "outcome", "content")  # a page is taken apart once for both
        part = known.select(F.lit(name).alias("site"), "id", "outcome", "title", "content", F.col("thumbnail").alias("image"))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"SELECT site, CAST(p_partkey AS VARCHAR) AS id, {_STATUS} AS outcome, CASE WHEN p_partkey % 10 > 1 THEN p_name END AS title FROM part, (VALUES ('A'), ('C')) AS s(site)")
def blog_archives(spark, sf_dir):
    """List pages joined with their detail pages, rejects apart."""
    out = None
    for name, item in (("A", _A_ITEM), ("C", _C_ITEM)):
        posts, rejects = archive.full(_lists(spark, sf_dir, item, f"archive-{name}"), _details(spark, sf_dir, name), html.site(name, BASE))
        part = posts.select("id", F.lit("ok").alias("outcome"), "title").unionByName(rejects.select("id", F.col("reason").alias("outcome"), F.lit(None).cast("string").alias("title")))
        part = part.select(F.lit(name).alias("site"), "id", "outcome", "title")
        out = part if out is None else out.unionByName(part)
    return out


def _calls(pages: DataFrame) -> DataFrame:
    """JSONP responses of pages (page, items)."""
    return pages.select("page", F.concat(F.lit("res("), F.to_json(F.struct(F.lit("1").alias("count"), F.col("items").alias("data"))), F.lit(");")).alias("value"))


@query(f"""
SELECT 'member' AS kind, CAST(s_suppkey AS VARCHAR) AS id, s_name AS title, '{BASE}/' || s_suppkey || '.jpg' AS image, '' AS content FROM supplier WHERE s_suppkey % 4 > 0 AND s_suppkey NOT IN (46, 10001)
UNION ALL SELECT kind, CAST(p_partkey AS VARCHAR), p_name, '{BASE}/' || p_partkey || '.jpg', CASE kind WHEN 'list' THEN '' ELSE '<img src="{BASE}/' || p_partkey || '.png"> ' || p_brand END FROM part, (VALUES ('list'), ('post')) AS k(kind)
UNION ALL SELECT 'detail', CAST(p_partkey AS VARCHAR), p_name, '{BASE}/' || p_partkey || '.jpg', '<img src="{BASE}/' || p_partkey || '.png"> ' || p_brand FROM part WHERE p_partkey = 12
""")
def jsonp_site(spark, sf_dir):
    """Members and posts of JSONP responses, one of which is broken; ``detail`` asks for one post."""
    key = F.col("id").cast("string")
    member = F.struct(key.alias("code"), "name", F.when(F.col("id") % 4 == 0, "YES").otherwise("NO").alias("graduation"), _text("/", key, ".jpg").alias("img"))
    people = _suppliers(spark, sf_dir).groupBy(F.floor(F.col("id") / 40).alias("page")).agg(_list(member).alias("items"))
    title = F.when(F.col("copy") == 1, F.col("title")).otherwise("again")
    post = F.struct(key.alias("code"), title.alias("title"), _text('<img src="/', key, '.png"> ', F.col("name")).alias("text"), F.lit("2025/11/03 21:09:45").alias("date"), F.lit("l").alias("link"), F.col("name"), F.lit("m").alias("arti_code"), _text("/", key, ".jpg").alias("img"))
    posts = by_page(_twice(_posts(spark, sf_dir), 100)).groupBy("page").agg(_list(post).alias("items"))
    members = jsonp.members(jsonp.responses(spark, land(_with_broken(_calls(people), "no call"), "jsonp-members")), BASE)
    rows = jsonp.responses(spark, land(_with_broken(_calls(posts), "res({);"), "jsonp-posts"))
    where = html.site("B", BASE)
    shown = lambda kind, found: found.select(F.lit(kind).alias("kind"), "id", "title", F.get("images", F.lit(0)).alias("image"), "content")
    out = members.select(F.lit("member").alias("kind"), "id", F.col("name").alias("title"), F.col("thumbnail_url").alias("image"), F.lit("").alias("content"))
    listed = html.blog_list(rows.withColumnRenamed("value", "html"), where)
    full, _ = archive.full(rows.withColumnRenamed("value", "html"), None, where)
    return out.unionByName(shown("list", listed)).unionByName(shown("post", full)).unionByName(shown("detail", jsonp.detail(rows, BASE, "12")))


def _raw_messages(spark, sf_dir) -> DataFrame:
    rows = _messages(spark, sf_dir).withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    return rows.withColumns({"group_id": F.lit(1).cast("long"), "page": F.lit("page-1"), "pos": F.lit(0)})


def _state(store: Store) -> DataFrame:
    newest = _ts(F.try_to_timestamp("last_sync_ts"))
    return store.state().select("member_id", "last_message_id", "total_messages", newest.alias("newest"))


@query(f"""
WITH cursors AS (SELECT user_id, max(ts) AS newest FROM events WHERE event_id % 3 > 0 GROUP BY user_id)
SELECT e.user_id AS member_id, max(event_id) AS last_message_id, count(*) AS total_messages, {_sql_ts('max(ts)')} AS newest
FROM events AS e LEFT JOIN cursors AS c ON c.user_id = e.user_id WHERE event_id % 3 > 0 OR c.newest IS NULL OR ts >= c.newest GROUP BY e.user_id""")
def sync_runs(spark, sf_dir):
    """Two runs over one store; the second brings all messages, and only those after the cursors are new."""
    store, rows = Store(spark, new_folder(spark, "store")), _raw_messages(spark, sf_dir)
    sync(store, rows.where("id % 3 > 0"))
    sync(store, rows)
    counted = store.messages().groupBy("member_id").agg(F.count("*").alias("stored"))
    return _state(store).join(counted.where("stored > 0"), "member_id").where("stored = total_messages").drop("stored")


@query(f"SELECT user_id AS member_id, max(event_id) AS last_message_id, count(*) AS total_messages, {_sql_ts('CASE WHEN user_id % 4 = 0 THEN min(ts) ELSE max(ts) END')} AS newest FROM events WHERE user_id % 5 > 0 GROUP BY user_id")
def sync_repairs(spark, sf_dir):
    """Corrupt members have no cursor after a run, a row without id holds its member's, and a failed write changes nothing."""
    store, rows = Store(spark, new_folder(spark, "store")), _raw_messages(spark, sf_dir)
    sync(store, rows)
    first = rows.where("member_id % 4 = 0").groupBy("group_id", "member_id").agg(F.min(F.struct(F.try_to_timestamp("published_at"), "published_at")).alias("x"))
    poison = first.select("group_id", "member_id", F.col("x.published_at").alias("published_at"))
    shut = rows.where("member_id % 5 = 0").select("group_id", "member_id").distinct()
    whole = Store(spark, new_folder(spark, "store"))
    sync(whole, rows.unionByName(poison, allowMissingColumns=True), corrupt=shut)
    before, replace = whole.current(), whole._replace
    whole._replace = lambda *_: False
    try:
        sync(whole, rows.limit(0))
    except OSError:
        pass
    whole._replace = replace
    return _state(whole).where(F.lit(whole.current() == before and store.messages().count() == rows.count()))


@query("SELECT user_id AS member_id, max(event_id) AS last_message_id, count(*) AS total_messages FROM events GROUP BY user_id")
def sync_stream(spark, sf_dir):
    """Landed page files as a stream, in two runs over one checkpoint."""
    item = F.struct("id", "member_id", "published_at", "type", "text")
    rows = _twice(_raw_messages(spark, sf_dir).drop("page", "pos"), 500).select("page", item.alias("item"))
    path = land(_envelopes(rows, "messages").withColumn("group", F.lit(1)), "stream", "group")
    store, checkpoint = new_folder(spark, "store"), new_folder(spark, "checkpoint")
    for _ in range(2):  # the second finds no new file
        with few_listings(spark):
            start(spark, path, store, checkpoint).awaitTermination()
    return Store(spark, store).state().select("member_id", "last_message_id", "total_messages")


@query(f"SELECT user_id AS member_id, 'member ' || user_id AS name, 'the group' AS group_name, count(*) AS total_messages, count(*) FILTER ({_TYPE} = 'text') AS n_text, count(*) FILTER ({_TYPE} = 'video') AS n_video, count(*) FILTER ({_TYPE} = 'picture') AS n_picture, count(*) FILTER ({_TYPE} = 'voice') AS n_voice, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ts, event_id) AS ids FROM events GROUP BY user_id")
def export_files(spark, sf_dir):
    """The documents of all members written as files, with header and counts, and read back."""
    stored = filters.normalize(_messages(spark, sf_dir)).withColumns({"group_id": F.lit(1).cast("long"), "timestamp": _ts("timestamp"), **{f.name: F.lit(None).cast(f.dataType) for f in schemas.MEDIA.fields}})
    person = F.col("member_id")
    header = stored.select("member_id").distinct().select(F.lit(1).cast("long").alias("group_id"), person.alias("id"), _text("member ", person).alias("name"), F.lit("the group").alias("group_name"), *(F.lit(None).cast("string").alias(c) for c in ("portrait", "thumbnail", "phone_image", "group_thumbnail")))
    path = new_folder(spark, "export")
    export.export(stored, header, path, F.timestamp_seconds(F.lit(0)))
    good, _ = landed.documents(spark, path)
    counts = [F.col(f"message_type_counts.{t}").alias(f"n_{t}") for t in stats.COUNTED]
    return good.select(F.col("member.id").alias("member_id"), "member.name", "member.group_name", "total_messages", *counts, F.array_join(F.transform("messages", lambda x: x["id"].cast("string")), ",").alias("ids"))


def _movie(width: int, height: int, millis: int, sound: bool) -> bytes:
    box = lambda kind, *parts: struct.pack(">I", 8 + sum(map(len, parts))) + kind + b"".join(parts)
    shown = box(b"trak", box(b"tkhd", b"\0" * 76 + struct.pack(">II", width << 16, height << 16)), box(b"mdia", box(b"hdlr", b"\0" * 8 + b"vide")))
    heard = box(b"trak", box(b"mdia", box(b"hdlr", b"\0" * 8 + b"soun")))
    head = box(b"mvhd", b"\0" * 12 + struct.pack(">II", 1000, millis) + b"\0" * 80)
    return box(b"ftyp", b"isom") + box(b"mdat", b"\0" * 200_000) + box(b"moov", head, shown, *([heard] if sound else []))


@query("""
SELECT 's' || s_suppkey || '.png' AS name, s_suppkey + 1 AS width, 2 * s_suppkey + 1 AS height, NULL AS media_duration, NULL AS is_muted, true AS by_ranges FROM supplier
UNION ALL SELECT 's' || s_suppkey || '.mp4', s_suppkey + 2, s_suppkey + 3, s_suppkey + 0.5, s_suppkey % 2 = 0, true FROM supplier
""")
def media_files(spark, sf_dir):
    """Sizes, duration and sound of a picture and a video for each supplier, written by executors; of a video's 200 kB the reader takes a few windows."""
    path = new_folder(spark, "media")

    def write(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                png = b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", k + 1, 2 * k + 1) + b"\x08\x02\0\0\0"
                for name, data in ((f"s{k}.png", png), (f"s{k}.mp4", _movie(k + 2, k + 3, 1000 * k + 500, k % 2 == 1))):
                    files.write_bytes(f"{path}/{k % 16}/{name}", data)
            yield batch

    keys = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("key"))
    keys.mapInArrow(write, "key long").write.format("noop").mode("overwrite").save()
    name = F.regexp_extract("path", r"([^/]+)$", 1).alias("name")
    ranges = media.headers(spark, path).select("path", (F.col("bytes_read") <= 8 * media.WINDOW).alias("by_ranges"))
    return media.probe(spark, path).join(ranges, "path").select(name, F.col("width").cast("long"), F.col("height").cast("long"), "media_duration", "is_muted", "by_ranges")


@query(f"""
WITH pages AS (SELECT event_id // 500 AS page, event_id, ts FROM events UNION ALL SELECT event_id // 500 + 1, event_id, ts FROM events),
firsts AS (SELECT event_id, min(page) AS page FROM pages GROUP BY event_id), fresh AS (SELECT page, count(*) AS n FROM firsts GROUP BY page)
SELECT 'scan/page-' || p.page || '.json' AS page, CAST((SELECT sum(n) FROM fresh AS f WHERE f.page <= p.page) AS BIGINT) AS seen, {_sql_ts('arg_max(ts, event_id)')} AS oldest FROM pages AS p GROUP BY p.page""")
def page_progress(spark, sf_dir):
    """Distinct messages so far and the last instant of every page, pages named by paths as readers name them."""
    rows = _twice(_messages(spark, sf_dir).select("id", "published_at"), 500).withColumn("pos", F.col("id")).withColumn("page", _text("scan/page-", F.col("page"), ".json"))
    return stats.page_progress(rows, ts="published_at").withColumn("oldest", _ts("oldest"))


@query("SELECT count(*) AS total, count(*) FILTER (value > 10) AS completed FROM events")
def observed_counts(spark, sf_dir):
    """Counts of rows and of successes, gathered while the rows are written."""
    rows, seen = stats.observed(_table(spark, sf_dir, "events"), "download", F.col("value") > 10)
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["total"], seen.get["completed"])], "total long, completed long")


@query(f"SELECT event_id AS id, {_RAW} AS raw_type, 'm/' || user_id || '/picture/' || event_id || '.png' AS path FROM events WHERE event_type = 'view' AND event_id % 2 = 1")
def media_outstanding(spark, sf_dir):
    """J1 with F3 and F7 over all messages: media that no file holds yet."""
    from tidemark.operators.joins import media_queue

    stored = filters.normalize(_messages(spark, sf_dir)).withColumn("group_id", F.lit(1).cast("long"))
    there = _messages(spark, sf_dir).where("type = 'image' and id % 2 = 0").select(_text("m/", F.col("member_id"), "/picture/", F.col("id"), ".png").alias("path"))
    return media_queue(stored, there, _text("m/", F.col("member_id"))).select("id", "raw_type", "path")


@query(f"""
WITH cursors AS (SELECT user_id, CASE WHEN user_id % 4 = 0 THEN min(ts) ELSE max(ts) END AS cursor FROM events WHERE event_id % 3 > 0 GROUP BY user_id)
SELECT e.user_id AS member_id, max(event_id) AS last_message_id, count(*) AS total_messages, {_sql_ts('max(ts)')} AS newest, true AS released
FROM events AS e LEFT JOIN cursors AS c ON c.user_id = e.user_id WHERE event_id % 3 > 0 OR c.cursor IS NULL OR ts >= c.cursor GROUP BY e.user_id""")
def member_states(spark, sf_dir):
    """T2-T4, T7 as keyed streaming state: a first run with a reject for every fourth member, which holds its cursor; a second that mends it and releases the cursor."""
    rows = _raw_messages(spark, sf_dir).drop("page", "pos")
    first = rows.where("id % 3 > 0")
    oldest = first.where("member_id % 4 = 0").groupBy("group_id", "member_id").agg(F.min(F.struct(F.try_to_timestamp("published_at"), "published_at")).alias("x"))
    poison = oldest.select("group_id", "member_id", F.col("x.published_at").alias("published_at"))
    item = F.struct("id", "member_id", "published_at", "type", "text", "file", "thumbnail")
    path, store, checkpoint = new_folder(spark, "states"), new_folder(spark, "states"), new_folder(spark, "checkpoint")
    for n, run in enumerate((first.unionByName(poison, allowMissingColumns=True), rows)):
        placed = _twice(run.where("id is not null"), 500).unionByName(run.where("id is null").withColumn("page", F.lit(0)), allowMissingColumns=True)
        pages = _envelopes(placed.select((F.col("page") + n * 10_000_000).cast("long").alias("page"), item.alias("item")), "messages")
        land(pages.withColumn("group", F.lit(1)), "states", "group", path=path)
        with few_listings(spark):
            member_state.start(page_stream(spark, path, 1_000_000), store, checkpoint).awaitTermination()
    found = member_state.state(spark, store)
    there = member_state.messages(spark, store).groupBy("member_id").agg(F.count("*").alias("stored"))
    shown = found.join(there, "member_id").where("stored = total_messages")
    return shown.select("member_id", "last_message_id", "total_messages", _ts(F.col("newest")).alias("newest"), F.expr("held is null and cursor = newest").alias("released"))


_SCANNED = """
WITH r AS (
  SELECT user_id % 5 AS g, event_id, ts, row_number() OVER (PARTITION BY user_id % 5 ORDER BY ts DESC, event_id DESC) - 1 AS rn, count(*) OVER (PARTITION BY user_id % 5) AS n FROM events
), c AS (SELECT g, ts AS cursor FROM r WHERE rn = n // 2), p AS (SELECT g, rn // 200 AS page, min(ts) AS oldest FROM r GROUP BY ALL),
stop AS (SELECT p.g, min(page) AS stop FROM p JOIN c USING (g) WHERE oldest <= cursor GROUP BY p.g)
"""


def _timeline(spark, sf_dir) -> tuple[str, dict[int, str]]:
    """Five timelines, newest page first, with their zone map, and a cursor in the middle of each."""
    rows = _raw_messages(spark, sf_dir).drop("page", "pos").withColumn("group_id", (F.col("member_id") % 5).cast("long"))
    newest = Window.partitionBy("group_id").orderBy(F.desc("published_at"), F.desc("id"))
    ranked = rows.withColumns({"rn": F.row_number().over(newest) - 1, "n": F.count("*").over(Window.partitionBy("group_id"))}).withColumn("page", F.floor(F.col("rn") / 200))
    item = F.struct("rn", F.struct("id", "member_id", "published_at", "type", "text").alias("m"))
    pages = ranked.groupBy(F.col("group_id").alias("group"), "page").agg(F.to_json(F.struct(F.transform(_list(item), lambda x: x["m"]).alias("messages"))).alias("value"))
    path = land(pages, "timeline", "group")
    scan.write_zones(ranked, path)
    cursors = {r["group_id"]: r["published_at"] for r in ranked.where("rn = floor(n / 2)").select("group_id", "published_at").collect()}  # always five
    return path, cursors


@query(_SCANNED + "SELECT g AS group_id, count(*) FILTER (ts >= cursor) AS messages, max(stop) + 1 AS pages, 1 AS times FROM r JOIN c USING (g) JOIN stop USING (g) GROUP BY g")
def timeline_scan(spark, sf_dir):
    """Timelines read page by page until their cursors by a source with offsets of its own; stopped after the first batch and taken up again, no page is read twice."""
    path, cursors = _timeline(spark, sf_dir)
    out, checkpoint, position = new_folder(spark, "scan"), new_folder(spark, "checkpoint"), f"{new_folder(spark, 'scan')}/position"
    per_batch = max(1, _table(spark, sf_dir, "events").count() // 8000)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    def begin(**trigger):
        rows = scan.stream(spark, path, position, cursors, per_batch)
        return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()

    begin(availableNow=True).awaitTermination()
    rest = begin(processingTime="0 seconds")
    rest.processAllAvailable()
    rest.stop()
    rows = spark.read.parquet(out).withColumn("at", F.try_to_timestamp("published_at"))
    known = spark.createDataFrame(list(cursors.items()), "group_id long, cursor string").withColumn("cursor", F.try_to_timestamp("cursor"))
    times = rows.groupBy("group_id", "page", "pos").agg(F.count("*").alias("times"), F.first("at").alias("at")).join(F.broadcast(known), "group_id")
    return times.groupBy("group_id").agg(F.count_if(F.col("at") >= F.col("cursor")).alias("messages"), F.countDistinct("page").alias("pages"), F.max("times").cast("int").alias("times"))


@query(_SCANNED + """
SELECT 'until' AS kind, g AS group_id, count(DISTINCT rn // 200) AS pages, count(*) AS messages FROM r JOIN stop USING (g) WHERE rn // 200 <= stop GROUP BY g
UNION ALL SELECT 'capped', g, count(DISTINCT rn // 200), count(*) FROM r JOIN stop USING (g) WHERE rn // 200 <= stop AND rn // 200 < 3 GROUP BY g""")
def zone_map(spark, sf_dir):
    """The zone map decides which pages are opened: those up to the cursor, and at most three of them."""
    path, cursors = _timeline(spark, sf_dir)
    known = spark.createDataFrame(list(cursors.items()), "group_id long, cursor string").withColumn("cursor", F.try_to_timestamp("cursor"))
    zones, out = scan.zones(spark, path).join(F.broadcast(known), "group_id"), None
    for kind, cap in (("until", None), ("capped", 3)):
        wanted = scan.pages_until(zones, ["group_id"], F.col("oldest") <= F.col("cursor"), cap)
        part = scan.read_pages(spark, path, wanted).groupBy("group_id").agg(F.countDistinct("page").alias("pages"), F.count("*").alias("messages")).select(F.lit(kind).alias("kind"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT event_id AS id, CASE event_id % 3 WHEN 0 THEN false WHEN 2 THEN value > 10 END AS is_favorite, event_id % 3 = 1 AS said_null, user_id AS extra FROM events")
def favorite_flags(spark, sf_dir):
    """A flag that is missing is false, one that is null stays null; a field that no schema names keeps its type in VARIANT."""
    key = F.col("event_id")
    flag = F.when(key % 3 == 0, "").when(key % 3 == 1, ',"is_favorite":null').otherwise(F.concat(F.lit(',"is_favorite":'), (F.col("value") > 10).cast("string")))
    item = F.concat(F.lit('{"id":'), key.cast("string"), flag, F.lit(',"extra":{"member":'), F.col("user_id").cast("string"), F.lit("}}"))
    pages = _table(spark, sf_dir, "events").groupBy(F.floor(key / 500).alias("page")).agg(F.concat(F.lit('{"messages":['), F.array_join(F.collect_list(item), ","), F.lit("]}")).alias("value"))
    path = land(pages, "favorites")
    rows = filters.normalize(landed.past_messages(spark, path)).select("id", "is_favorite")
    get = lambda place, kind: F.try_variant_get("item", place, kind)
    raw = landed.variants(spark, path, "messages").select(get("$.id", "long").alias("id"), F.is_variant_null(get("$.is_favorite", "variant")).alias("said_null"), get("$.extra.member", "long").alias("extra"))
    return rows.join(raw, "id").select("id", "is_favorite", F.coalesce("said_null", F.lit(False)).alias("said_null"), "extra")


@query("SELECT site, CAST(p_partkey AS VARCHAR) AS id FROM part, (VALUES ('A'), ('C')) AS s(site) WHERE p_partkey // 100 < 12")
def page_cap(spark, sf_dir):
    """O3, O1: the posts of the first twelve list pages, in the order of their numbers."""
    out = None
    for name, item in (("A", _A_ITEM), ("C", _C_ITEM)):
        part = html.blog_list(_lists(spark, sf_dir, item, f"cap-{name}"), html.site(name, BASE), max_pages=12).select(F.lit(name).alias("site"), "id")
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT event_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS exported_at FROM events")
def export_clock(spark, sf_dir):
    """instants as the export writes them."""
    return _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), S.export_clock(F.col("ts").cast("timestamp")).alias("exported_at"))


@query("""
SELECT 'unseen' AS kind, event_id AS id FROM events WHERE event_id % 3 > 0 UNION ALL SELECT 'within', event_id FROM events WHERE event_id % 3 = 0
UNION ALL SELECT 'queue', event_id FROM events WHERE event_type = 'view' AND event_id % 2 = 1""")
def seen_messages(spark, sf_dir):
    """Messages whose ids were seen before or not, and media that no file holds yet, by a membership filter before the exact join."""
    rows = _messages(spark, sf_dir)
    seen = rows.where("id % 3 = 0").select("id")
    stored = filters.normalize(rows).withColumn("group_id", F.lit(1).cast("long"))
    place = _text("m/", F.col("member_id"))
    there = rows.where("type = 'image' and id % 2 = 0").select(F.concat(place, F.lit("/picture/"), F.col("id").cast("string"), F.lit(".png")).alias("path"))
    parts = {"unseen": membership.unseen(rows, seen, ["id"]), "within": membership.within(rows, seen, ["id"]), "queue": joins.media_queue(stored, there, place, filtered=True)}
    found = [part.select(F.lit(kind).alias("kind"), "id") for kind, part in parts.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])
