"""Driver queries for the library's operators, with the SQL that gives the same rows.

The driver's tables stand in for timelines and archives: ``events`` for messages
(event_id, ts, user_id, event_type, props), ``orders`` for groups with a state,
``pages`` for post pages, ``documents`` and ``labels`` for posts and media
measures, customers and suppliers for members.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import cursor, dedup, filters, joins, stats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw_type(c: str = "event_type") -> Column:
    return F.when(F.col(c) == "view", "image").when(F.col(c) == "click", "movie").when(F.col(c) == "purchase", "voice").otherwise(F.col(c))


_RAW = "CASE event_type WHEN 'view' THEN 'image' WHEN 'click' THEN 'movie' WHEN 'purchase' THEN 'voice' ELSE event_type END"
_TYPE = "CASE event_type WHEN 'view' THEN 'picture' WHEN 'click' THEN 'video' WHEN 'purchase' THEN 'voice' ELSE 'text' END"


def _ts(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _sql_ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("member_id"), F.col("ts").alias("published_at"), _raw_type().alias("type"), F.col("props").alias("text"), (F.col("value") > 10).alias("is_favorite"), F.lit(None).cast("string").alias("file"), F.when(F.col("event_type") == "view", F.lit("thumb.PNG?size=1")).alias("thumbnail"))


@query(f"SELECT event_id AS id, user_id AS member_id, {_sql_ts('ts')} AS timestamp, {_TYPE} AS type, value > 10 AS is_favorite, props AS content, {_RAW} AS raw_type, CASE WHEN event_type = 'view' THEN 'thumb.PNG?size=1' END AS media_url FROM events")
def normalize_messages(spark, sf_dir):
    """F1, F15, F18, P10."""
    return filters.normalize(_messages(spark, sf_dir)).withColumn("timestamp", _ts("timestamp"))


@query(f"SELECT user_id AS member_id, count(*) FILTER ({_TYPE} = 'text') AS n_text, count(*) FILTER ({_TYPE} = 'video') AS n_video, count(*) FILTER ({_TYPE} = 'picture') AS n_picture, count(*) FILTER ({_TYPE} = 'voice') AS n_voice, count(*) AS total_messages FROM events GROUP BY user_id")
def message_type_counts(spark, sf_dir):
    """A1, A2."""
    stored = filters.normalize(_messages(spark, sf_dir))
    return stored.groupBy("member_id").agg(*stats.type_counts(F.col("type")), F.count("*").alias("total_messages"))


@query(f"SELECT user_id AS member_id, count(*) AS total_messages, coalesce(max(event_id), 0) AS last_message_id, {_sql_ts('max(ts)')} AS last_sync_ts FROM events GROUP BY user_id")
def sync_state(spark, sf_dir):
    """A2-A4, K3."""
    report = stats.member_report(filters.normalize(_messages(spark, sf_dir)), ["member_id"])
    return report.select("member_id", "total_messages", "last_message_id", _ts("last_sync_ts").alias("last_sync_ts"))


@query(f"WITH s AS (SELECT user_id, max(ts) AS c FROM events WHERE event_type = 'purchase' GROUP BY user_id) SELECT event_id AS id, e.user_id AS member_id, {_sql_ts('ts')} AS published_at FROM events e LEFT JOIN s USING (user_id) WHERE c IS NULL OR ts >= c")
def cursor_incremental(spark, sf_dir):
    """Every member's rows from its own cursor on, in one plan."""
    messages = _messages(spark, sf_dir)
    state = messages.where("type = 'voice'").groupBy("member_id").agg(F.max("published_at").alias("last_sync_ts"))
    return cursor.after_cursor(messages, state, ["member_id"]).select("id", "member_id", _ts("published_at").alias("published_at"))


@query("WITH f AS (SELECT min(event_id) AS id FROM events WHERE event_type = 'error') SELECT event_id AS id FROM events WHERE ts >= (SELECT ts FROM events WHERE event_id = (SELECT id FROM f))")
def since_id_known(spark, sf_dir):
    """P4 with the id among the rows: its instant is the cursor."""
    messages = _messages(spark, sf_dir)
    first = messages.where("type = 'error'").agg(F.min("id")).first()[0]
    return cursor.after_id(messages, first).select("id")


@query("SELECT event_id AS id FROM events WHERE event_id > (SELECT max(event_id) // 2 FROM events) AND event_type <> 'click' AND (SELECT event_type FROM events WHERE event_id = (SELECT max(event_id) // 2 FROM events)) = 'click' OR event_type <> 'click' AND (SELECT event_type FROM events WHERE event_id = (SELECT max(event_id) // 2 FROM events)) <> 'click' AND ts >= (SELECT ts FROM events WHERE event_id = (SELECT max(event_id) // 2 FROM events))")
def since_id_fallback(spark, sf_dir):
    """P4 on rows that may lack the id: then greater ids."""
    messages = _messages(spark, sf_dir)
    middle = messages.agg(F.max("id")).first()[0] // 2
    return cursor.after_id(messages.where("type <> 'movie'"), middle).select("id")


@query("WITH u AS (SELECT event_id, value, 0 AS page FROM events UNION ALL SELECT event_id, value + 1, 1 FROM events WHERE event_type = 'click') SELECT event_id AS id, arg_max(value, page) AS value, max(page) AS page FROM u GROUP BY event_id")
def page_dedup_last_wins(spark, sf_dir):
    """Pages that overlap; the page read last wins."""
    events = _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "value", "event_type")
    pages = events.drop("event_type").withColumn("page", F.lit(0)).unionByName(events.where("event_type = 'click'").select("id", (F.col("value") + 1).alias("value"), F.lit(1).alias("page")))
    return dedup.last_wins(pages, ["id"], ["page"])


@query("WITH o AS (SELECT event_id AS id, value, CASE WHEN event_type = 'view' THEN 640 END AS width FROM events WHERE event_type <> 'signup'), n AS (SELECT event_id AS id, value * 2 AS value, CAST(NULL AS INT) AS width FROM events WHERE event_type IN ('view', 'signup')) SELECT coalesce(n.id, o.id) AS id, CASE WHEN n.id IS NOT NULL THEN n.value ELSE o.value END AS value, coalesce(n.width, o.width, -1) AS width FROM o FULL JOIN n ON o.id = n.id")
def upsert_merge(spark, sf_dir):
    """New rows replace old ones, known media measures stay."""
    events = _table(spark, sf_dir, "events")
    old = events.where("event_type <> 'signup'").select(F.col("event_id").alias("id"), "value", F.when(F.col("event_type") == "view", 640).alias("width"))
    new = events.where("event_type in ('view', 'signup')").select(F.col("event_id").alias("id"), (F.col("value") * 2).alias("value"), F.lit(None).cast("int").alias("width"))
    return dedup.upsert(old, new, ["id"], keep=("width",)).withColumn("width", F.coalesce("width", F.lit(-1)))


@query("SELECT md5(text) AS post, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY text")
def list_dedup_first_wins(spark, sf_dir):
    """D3: of equal posts the first in page order."""
    posts = _table(spark, sf_dir, "documents").select(F.md5("text").alias("post"), "doc_id", "source")
    return dedup.first_wins(posts, ["post"], ["doc_id"])


@query("WITH u AS (SELECT c_nationkey AS id, c_name AS name, 0 AS source_rank, c_custkey AS pos FROM customer WHERE c_mktsegment = 'MACHINERY' UNION ALL SELECT s_nationkey, s_name, 1, s_suppkey FROM supplier) SELECT id, name, source_rank, pos FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY source_rank, pos) AS rn FROM u) WHERE rn = 1")
def ordered_union(spark, sf_dir):
    """A preferred list, then unseen ids of another."""
    first = _table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_nationkey").alias("id"), F.col("c_name").alias("name"), F.col("c_custkey").alias("pos"))
    other = _table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("id"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("pos"))
    return dedup.ordered_union(first, other, ["id"], ["pos"])


@query("SELECT user_id AS member_id, event_id AS id FROM (SELECT *, max(CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY value DESC, event_id ROWS UNBOUNDED PRECEDING) AS stopped FROM events) WHERE stopped = 0")
def take_while_since(spark, sf_dir):
    """Each member's rows in list order, up to the first that is too old."""
    rows = _messages(spark, sf_dir).join(_table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), (-F.col("value")).alias("page")), "id")
    stop = cursor.older_than(F.col("published_at"), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return cursor.take_while(rows, ["member_id"], ["page", "id"], stop).select("member_id", "id")


@query("SELECT user_id AS member_id, event_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type <> 'error' THEN ts END NULLS FIRST, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END, event_id) AS place FROM events")
def merge_order(spark, sf_dir):
    """O1, O2: the stored order of each member's messages."""
    from pyspark.sql import Window

    m = _messages(spark, sf_dir)
    order = stats.stored_order(F.when(F.col("type") != "error", F.col("published_at")), F.when(F.col("type") == "signup", 1).otherwise(0), F.col("id"))
    return m.select("member_id", "id", F.row_number().over(Window.partitionBy("member_id").orderBy(*order)).cast("long").alias("place"))


@query(f"WITH a AS (SELECT user_id AS member_id, max(ts) FILTER (event_type <> 'error') AS newest, min(ts) FILTER (event_type = 'error') AS failed FROM events GROUP BY user_id) SELECT member_id, {_sql_ts('newest')} AS newest, {_sql_ts('failed')} AS earliest_failed, {_sql_ts('CASE WHEN newest IS NOT NULL AND failed IS NOT NULL THEN least(newest, failed) ELSE newest END')} AS last_sync_ts FROM a WHERE newest IS NOT NULL")
def poison_clamp(spark, sf_dir):
    """Errors are rejects that hold their member's cursor."""
    m = filters.normalize(_messages(spark, sf_dir))
    good, bad = m.where("raw_type <> 'error'"), m.where("raw_type = 'error'")
    report = stats.member_report(good, ["member_id"]).join(cursor.earliest_failed(bad, ["member_id"]), "member_id", "left")
    clamped = cursor.clamp(F.col("last_sync_ts"), F.col("earliest_failed"))
    return report.select("member_id", _ts("last_sync_ts").alias("newest"), _ts("earliest_failed").alias("earliest_failed"), _ts(clamped).alias("last_sync_ts"))


@query("WITH s AS (SELECT user_id, count(*) AS total FROM events WHERE event_type <> 'view' GROUP BY user_id), a AS (SELECT user_id, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY user_id) SELECT s.user_id AS member_id, total AS total_messages, coalesce(n, 0) AS actual_messages, total > 0 AND coalesce(n, 0) < total AS needs_full_refetch FROM s LEFT JOIN a USING (user_id)")
def integrity_check(spark, sf_dir):
    """Members with fewer stored rows than their state says."""
    m = _messages(spark, sf_dir)
    state = m.where("type <> 'image'").groupBy("member_id").agg(F.count("*").alias("total_messages"))
    return cursor.lost_rows(state, m.where("type <> 'movie'"), ["member_id"])


_SUBSCRIPTION = "CASE o_orderpriority WHEN '1-URGENT' THEN 'active' WHEN '5-LOW' THEN NULL ELSE 'expired' END"


def _groups(spark, sf_dir) -> DataFrame:
    subscription = F.when(F.col("o_orderpriority") == "1-URGENT", "active").when(F.col("o_orderpriority") == "5-LOW", None).otherwise("expired")
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("state"), subscription.alias("subscription"))


@query(f"SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F' OR coalesce({_SUBSCRIPTION} = 'active', false)")
def group_state_filter(spark, sf_dir):
    """P1, S2."""
    return _groups(spark, sf_dir).where(filters.group_visible(F.col("state"), F.col("subscription"))).select("id")


@query(f"SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F' OR {_SUBSCRIPTION} IS NOT NULL")
def group_state_all(spark, sf_dir):
    """P1 with inactive groups."""
    return _groups(spark, sf_dir).where(filters.group_visible(F.col("state"), F.col("subscription"), True)).select("id")


@query("SELECT c_custkey AS id, c_name AS name, c_nationkey AS group_id, n_name AS group_name, r_name AS group_thumbnail FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def demux_member_header(spark, sf_dir):
    """P2, J5."""
    nations = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    members = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("group_id"))
    return joins.member_header(members, nations.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("r_name").alias("thumbnail")))


@query("SELECT conv_id, turn FROM conversations WHERE NOT (role <> 'assistant' AND CASE WHEN length(text) < 60 THEN '' ELSE text END = '' AND CASE WHEN role = 'system' THEN 'x.png' ELSE '' END = '')")
def empty_skip(spark, sf_dir):
    """P8, with short turns as empty ones and media on system turns."""
    kind = F.when(F.col("role") == "assistant", "voice").otherwise("text")
    content = F.when(F.length("text") < 60, "").otherwise(F.col("text"))
    return _table(spark, sf_dir, "conversations").where(filters.not_empty(kind, content, F.when(F.col("role") == "system", "x.png"))).select("conv_id", "turn")


@query(r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace('../' || url || chr(9) || '..\a ', '[\x00-\x1F]', '', 'g'), '[/\\]', '_', 'g'), '\.\.', '_', 'g'), '[<>:"|?*]', '_', 'g'), '^\s+|\s+$', '', 'g') AS name FROM pages""")
def sanitize_names(spark, sf_dir):
    """F2, F12, K7."""
    return _table(spark, sf_dir, "pages").select("page_id", S.sanitize_name(F.concat(F.lit("../"), "url", F.lit("\t..\\a "))).alias("name"))


_MEDIA_URL = "split_part(split_part(url, '?', 1), '#', 1) || CASE WHEN contains(url, '?') THEN '.JPG?x=.gif' WHEN contains(url, '#') THEN '.exe#.png' ELSE '' END"


@query(f"WITH u AS (SELECT page_id, {_MEDIA_URL} AS u FROM pages), x AS (SELECT page_id, lower(regexp_extract(regexp_extract(u, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '\\.([^.]*)$', 1)) AS e FROM u) SELECT page_id, CASE WHEN e IN ('jpg', 'jpeg', 'png', 'gif', 'webp', 'm4a', 'mp3', 'wav', 'mp4', 'mov', 'webm') THEN e ELSE 'm4a' END AS extension, 'm/voice/' || page_id || '.' || CASE WHEN e IN ('jpg', 'jpeg', 'png', 'gif', 'webp', 'm4a', 'mp3', 'wav', 'mp4', 'mov', 'webm') THEN e ELSE 'm4a' END AS path FROM x")
def media_extension(spark, sf_dir):
    """F3, F7, K5."""
    bare = F.split(F.split("url", r"\?")[0], "#")[0]
    url = F.concat(bare, F.when(F.contains("url", F.lit("?")), ".JPG?x=.gif").when(F.contains("url", F.lit("#")), ".exe#.png").otherwise(""))
    rows = _table(spark, sf_dir, "pages").select("page_id", S.media_extension(url, F.lit("voice")).alias("extension"))
    return rows.withColumn("path", S.media_path(F.lit("m"), F.lit("voice"), "page_id", "extension"))


@query("""WITH v AS (SELECT page_id, url, regexp_replace(url, '^https?:', '') AS slashed, regexp_replace(url, '^https?://[^/]*', '') AS rooted, regexp_replace(url, '^https?://[^/]*/', '') AS bare FROM pages)
SELECT page_id, url AS whole, 'https:' || slashed AS slashed, 'https://b.example' || rooted AS rooted, 'https://b.example/' || bare AS bare, 'mailto:' || page_id AS mail, '#' || page_id AS fragment, '' AS empty FROM v""")
def url_normalize(spark, sf_dir):
    """F6 on every form of URL."""
    f = lambda c: S.normalize_url(c, "https://b.example")
    cut = lambda p: F.regexp_replace("url", p, "")
    page = F.col("page_id").cast("string")
    return _table(spark, sf_dir, "pages").select("page_id", f("url").alias("whole"), f(cut("^https?:")).alias("slashed"), f(cut("^https?://[^/]*")).alias("rooted"), f(cut("^https?://[^/]*/")).alias("bare"), f(F.concat(F.lit("mailto:"), page)).alias("mail"), f(F.concat(F.lit("#"), page)).alias("fragment"), f(F.lit(None).cast("string")).alias("empty"))


@query("""SELECT page_id, md5(regexp_replace(html, '(src|href)="(/[^/"''][^"'']*|/)"', '\\1="https://b.example\\2"', 'g')) AS digest FROM pages""")
def html_url_rewrite(spark, sf_dir):
    """F8."""
    return _table(spark, sf_dir, "pages").select("page_id", F.md5(S.normalize_html_urls("html", "https://b.example")).alias("digest"))


@query("""WITH t AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS raw FROM pages) SELECT page_id, raw AS title, regexp_replace(raw || ' | a | b', '(?s)^(.*) \\| .*$', '\\1') AS cut FROM t""")
def html_title(spark, sf_dir):
    """H4, F13."""
    raw = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    return _table(spark, sf_dir, "pages").select("page_id", raw.alias("title"), S.cut_title_suffix(F.concat(raw, F.lit(" | a | b"))).alias("cut"))


@query("""SELECT page_id, CAST(pos AS BIGINT) AS pos, 'https://b.example' || u AS url FROM (SELECT page_id, unnest(m) AS u, generate_subscripts(m, 1) - 1 AS pos FROM (SELECT page_id, regexp_extract_all(replace(html, '<a href', '<img src'), '(?i)<img\\b[^>]*?\\ssrc\\s*=\\s*["'']([^"'']+)["'']', 1) AS m FROM pages))""")
def link_extract(spark, sf_dir):
    """H7, with links as images."""
    images = S.image_sources(F.replace("html", F.lit("<a href"), F.lit("<img src")), "https://b.example")
    return _table(spark, sf_dir, "pages").select("page_id", F.posexplode(images).alias("pos", "url")).withColumn("pos", F.col("pos").cast("long"))


@query("SELECT event_id AS id, CASE event_type WHEN 'error' THEN -1 WHEN 'view' THEN -1 ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k, CASE event_type WHEN 'error' THEN 'not a callback' WHEN 'view' THEN 'not JSON' END AS reason FROM events")
def jsonp_parse(spark, sf_dir):
    """Calls, other texts and broken JSON."""
    from pyspark.sql import types as T

    from tidemark.sources import jsonp

    events = _table(spark, sf_dir, "events")
    wrapped = F.when(F.col("event_type") == "error", F.concat(F.lit(" res("), "props", F.lit(")"))).when(F.col("event_type") == "view", F.concat(F.lit('res({"data":[ '), "props", F.lit(");"))).otherwise(F.concat(F.lit('res({"data":['), "props", F.lit("]}); \n")))
    rows = events.select(F.col("event_id").cast("string").alias("page"), wrapped.alias("value"))
    good, bad = jsonp.parse(rows, T.StructType([T.StructField("k", T.LongType())]))
    id_ = F.col("page").cast("long").alias("id")
    return good.select(id_, "k", F.lit(None).cast("string").alias("reason")).unionByName(bad.select(id_, F.lit(-1).cast("long").alias("k"), "reason"))


@query("""WITH f AS (SELECT event_id AS id, event_type AS e, ts FROM events)
SELECT id, CASE e WHEN 'error' THEN NULL ELSE strftime(CASE e WHEN 'view' THEN date_trunc('minute', ts) WHEN 'click' THEN date_trunc('second', ts) WHEN 'signup' THEN date_trunc('minute', ts) ELSE date_trunc('day', ts) END - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') END AS published_at, e NOT IN ('view', 'click', 'signup') AS date_only FROM f""")
def multi_format_dates(spark, sf_dir):
    """site dates of all forms as UTC instants; what fits no form is null."""
    e = F.col("event_type")
    forms = {"view": "yyyy.M.d H:m", "click": "yyyy/M/d H:m:s", "signup": "yyyy/M/d H:m", "purchase": "yyyy/M/d"}
    text = F.lit("soon")
    for kind, form in forms.items():
        text = F.when(e == kind, F.date_format("ts", form)).otherwise(text)
    rows = _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.concat(F.lit("　"), text, F.lit(" ")).alias("text"))
    return rows.select("id", F.date_format(S.site_datetime("text"), "yyyy-MM-dd HH:mm:ss").alias("published_at"), S.date_only("text").alias("date_only"))


@query("SELECT event_id AS id, CASE WHEN event_type = 'error' THEN -1 ELSE 1700000000 + event_id END AS expires, event_type = 'error' OR 1700000000 + event_id - 1700000500 <= 0 AS expired FROM events")
def jwt_expiry(spark, sf_dir):
    """F10, F11."""
    claims = F.concat(F.lit('{"exp":'), (F.col("event_id") + 1700000000).cast("string"), F.lit(',"n":"'), F.col("event_type"), F.lit('"}'))
    body = F.translate(F.base64(F.encode(claims, "utf-8")), "+/=", "-_")
    token = F.when(F.col("event_type") == "error", "a.%%%.c").otherwise(F.concat(F.lit("h."), body, F.lit(".s")))
    now = F.timestamp_seconds(F.lit(1700000500))
    return _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.coalesce(S.token_expiry(token), F.lit(-1)).alias("expires"), S.token_expired(token, now).alias("expired"))


@query("SELECT c_custkey AS id FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING') OR c_acctbal < 0")
def author_match(spark, sf_dir):
    """Names that differ only in spaces match; an empty name matches any."""
    c = _table(spark, sf_dir, "customer")
    shown = F.when(F.col("c_acctbal") < 0, "").when(F.col("c_mktsegment") == "MACHINERY", F.replace("c_name", F.lit("#"), F.lit(" #　"))).when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(F.concat(F.lit("x"), "c_name"))
    return c.where(filters.same_author(shown, F.col("c_name"))).select(F.col("c_custkey").alias("id"))


@query("SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey NOT IN (3, 4)")
def active_members(spark, sf_dir):
    """The member filters."""
    c = _table(spark, sf_dir, "customer")
    graduation = F.when(F.col("c_mktsegment") == "MACHINERY", "NO").when(F.col("c_mktsegment") == "BUILDING", "YES")
    code = F.when(F.col("c_nationkey") == 3, "46").otherwise(F.concat(F.lit("m"), F.col("c_custkey").cast("string")))
    group = F.when(F.col("c_nationkey") == 4, "all").otherwise(F.col("c_name"))
    return c.where(filters.active_member(code, F.col("c_name"), graduation) & filters.no_group_account(group, ("all",)) & filters.filled(F.col("c_name"), code)).select(F.col("c_custkey").alias("id"))


@query("SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'gone' ELSE 'error' END WHEN 'O' THEN 'ok' ELSE 'gone' END AS outcome FROM orders")
def status_routing(spark, sf_dir):
    """P11, S17."""
    status = F.when(F.col("o_orderstatus") == "O", 200).when(F.col("o_orderstatus") == "P", 404).when(F.col("o_orderpriority") == "1-URGENT", 410).otherwise(503)
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), filters.route(status).alias("outcome"))


@query("SELECT doc_id AS id, 'm/picture/' || doc_id || '.jpg' AS path FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def media_queue(spark, sf_dir):
    """Files that are not there yet, labels standing for those that are."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("https://x.example/a.jpg").alias("media_url"), F.lit("picture").alias("raw_type"))
    present = _table(spark, sf_dir, "labels").select(S.media_path(F.lit("m"), F.lit("picture"), "doc_id", F.lit("jpg")).alias("path"))
    return joins.media_queue(docs, present, F.lit("m")).select("id", "path")


@query("WITH l AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) SELECT d.doc_id AS id, coalesce(quality, 7) AS width, CAST(n_chars AS BIGINT) AS height FROM documents d LEFT JOIN l USING (doc_id)")
def metadata_mergeback(spark, sf_dir):
    """Known values replace stored ones, unknown ones do not."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit(7).alias("width"), F.col("n_chars").alias("height"))
    found = _table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("id")).agg(F.max("quality").alias("width"), F.lit(None).cast("long").alias("height"))
    return joins.merge_metadata(docs, found, ["id"], ["width", "height"])


@query("SELECT d.doc_id AS id, d.source AS source, b.doc_id IS NOT NULL AS found, CASE WHEN b.doc_id IS NULL THEN 'missing' WHEN b.toxic = 1 THEN 'gone' END AS reason FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id) b USING (doc_id)")
def list_to_detail(spark, sf_dir):
    """Posts with their detail, and the rest with the reason."""
    listed = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source")
    details = _table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("id")).agg(F.when(F.max("toxic") == 1, "gone").otherwise("ok").alias("outcome"))
    good, bad = joins.list_to_detail(listed, details)
    return good.select("id", "source", F.lit(True).alias("found"), F.lit(None).cast("string").alias("reason")).unionByName(bad.select("id", "source", (F.col("reason") != "missing").alias("found"), "reason"))


@query("SELECT event_id AS id, event_type AS plain, '***REDACTED***' AS token, '***REDACTED***' AS cookie FROM events")
def redact_props(spark, sf_dir):
    """F9, at two levels."""
    from pyspark.sql import types as T

    inner = F.create_map(F.lit("Cookie"), F.col("props"), F.lit("plain"), F.col("event_type"))
    outer = F.struct(F.col("props").alias("token"), inner.alias("headers"))
    kind = T.StructType([T.StructField("token", T.StringType()), T.StructField("headers", T.MapType(T.StringType(), T.StringType()))])
    masked = _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), S.redact(outer, kind).alias("r"))
    return masked.select("id", F.col("r.headers")["plain"].alias("plain"), F.col("r.token").alias("token"), F.col("r.headers")["Cookie"].alias("cookie"))


@query("SELECT doc_id AS id, CASE WHEN lang = 'en' THEN 'a;b' WHEN lang = 'de' THEN 'b' ELSE 'm;a;b' END AS images, CASE WHEN lang = 'en' THEN 'a' WHEN lang = 'de' THEN 'b' ELSE 'm' END AS thumbnail FROM documents")
def main_image(spark, sf_dir):
    """D5, A9."""
    main = F.when(F.col("lang") == "en", "b").when(F.col("lang") == "de", "").otherwise("m")
    inner = F.when(F.col("lang") == "de", F.array(F.lit("b"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    images = dedup.with_main_image(main, inner)
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array_join(images, ";").alias("images"), stats.first_image(images).alias("thumbnail"))


@query("SELECT page_id, 'http://x/' || page_id || '.jpg' AS quoted, 'http://x/' || page_id || '.jpg' AS bare, '' AS none FROM pages")
def background_image(spark, sf_dir):
    """H6."""
    page = F.col("page_id").cast("string")
    return _table(spark, sf_dir, "pages").select("page_id", S.background_url(F.concat(F.lit("color:red; background-image: url('http://x/"), page, F.lit(".jpg')"))).alias("quoted"), S.background_url(F.concat(F.lit("background-image:url(http://x/"), page, F.lit(".jpg)"))).alias("bare"), S.background_url(F.lit("color: red")).alias("none"))


@query("SELECT user_id AS member_id, count(*) AS total_messages, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ts, event_id) AS ids FROM events GROUP BY user_id")
def member_documents(spark, sf_dir):
    """K2: the nested document of every member, here its ids in stored order."""
    from tidemark.sinks import export
    from tidemark.sources import schemas

    stored = filters.normalize(_messages(spark, sf_dir)).withColumns({"group_id": F.lit(1).cast("long"), "timestamp": _ts("timestamp"), **{f.name: F.lit(None).cast(f.dataType) for f in schemas.MEDIA.fields}})
    header = spark.createDataFrame([], "group_id long, id long, name string, group_name string, portrait string, thumbnail string, phone_image string, group_thumbnail string")
    docs = export.documents(stored, header, F.timestamp_seconds(F.lit(0)))
    return docs.select("member_id", "total_messages", F.array_join(F.transform("messages", lambda x: x["id"].cast("string")), ",").alias("ids"))


@query("SELECT user_id AS member_id, arg_max(event_type || event_id, ts) AS name FROM events GROUP BY user_id")
def latest_name(spark, sf_dir):
    """K7."""
    rows = _table(spark, sf_dir, "events").select(F.lit(1).alias("group_id"), F.col("user_id").alias("member_id"), F.concat("event_type", F.col("event_id").cast("string")).alias("name"), F.col("ts").alias("seen_at"))
    return joins.latest_name(rows).select("member_id", "name")


@query("SELECT user_id AS member_id, user_id || '_' || event_type AS key, CASE WHEN value <> 0 THEN value / 1000.0 END AS duration FROM events")
def member_slice(spark, sf_dir):
    """F14, F16 over all messages, and P2 of every member, as a join with the members."""
    rows = _table(spark, sf_dir, "events").withColumnRenamed("user_id", "member_id")
    members = rows.select("member_id").distinct()
    return rows.join(members, "member_id", "left_semi").select("member_id", S.state_key("member_id", "event_type").alias("key"), S.seconds("value").alias("duration"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-member report: counts by type, total, greatest id and newest instant."""
    return stats.member_report(filters.normalize(_messages(spark, sf_dir)), ["member_id"])
