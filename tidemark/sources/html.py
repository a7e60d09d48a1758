"""HTML pages of sites A and C.

Input rows are (page, status, html) and whatever other columns; an extractor
turns each page into rows by an Arrow UDF, one page at a time, and everything
after that (URLs, dates, deduplication, filters) is native.  Metadata and
content are separate extractors, since Spark cannot prune inside a UDF.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators.dedup import first_wins, ordered_union
from tidemark.operators.filters import filled, no_group_account, route, same_author
from tidemark.operators.order import natural, reading_order
from tidemark.sinks.shared import whole_files
from tidemark.sources import jsonp
from tidemark.sources.markup import Element, parse

# Accounts that stand for a whole group, and the selectors of the sites.
GROUP_ACCOUNTS = {"A": ("日向坂46",), "C": ("櫻坂46",)}
A_LIST, A_TITLE, A_DATE, A_NAME, A_TEXT = ".p-blog-article", ".c-blog-article__title", ".c-blog-article__date", ".c-blog-article__name", ".c-blog-article__text"
A_MEMBER_NAME = ".name, .p-blog-member__name"
C_LIST, C_TITLE, C_LIST_TITLE, C_DATE, C_NAME = "li.box", ".title, h1.title, h2.title", ".title, .ttl, h3", ".blog-foot .date", ".name, .prof-name, .blog-name"
C_CONTENT = (".box-article", ".blog-detail-txt", ".article-body", ".entry-content", "article .txt")
DETAIL_LINK, DETAIL_ID = 'a[href*="/diary/detail/"]', re.compile(r"/diary/detail/(\d+)")
A_CATEGORY, A_ARTIST, C_ARTIST = re.compile(r"ct=(\d+)"), re.compile(r"/artist/(\d+)"), re.compile(r"/s/s46/artist/(\d+)")

FIELDS = ("id", "title", "content", "date_text", "images", "member_id", "member_name", "style")


def _text(root: Element | None, selector: str) -> str:
    x = root.first(selector) if root is not None else None
    return x.text() if x is not None else ""


def _image(root: Element | None) -> str:
    x = root.first("img") if root is not None else None
    return x.attrs.get("src", "") if x is not None else ""


def _links(root: Element, part: str, pattern: re.Pattern) -> Iterator[tuple[str, Element]]:
    for link in root.select(f'a[href*="{part}"]'):
        found = pattern.search(link.attrs.get("href", ""))
        if found:
            yield found[1], link


def a_members(root: Element) -> Iterator[dict]:
    """H1: category links of the diary page."""
    for number, link in _links(root, "ct=", A_CATEGORY):
        yield {"id": number, "member_name": link.text() or _text(link.above("div"), A_MEMBER_NAME)}


def a_artists(root: Element) -> Iterator[dict]:
    """H2: artist links with an image in or around them."""
    for number, link in _links(root, "/artist/", A_ARTIST):
        around = link.above("li", "div")
        name = link.text() or (next(around.strings(), "") if around is not None else "")
        yield {"id": number, "member_name": name, "images": [link.first("img") is not None and _image(link) or _image(around)]}


def a_diary_members(root: Element) -> Iterator[dict]:
    """H2: category links of the diary page with the image of their container."""
    for number, link in _links(root, "ct=", A_CATEGORY):
        around = link.above("li", "div")
        if around is not None:
            yield {"id": number, "member_name": _text(around, A_MEMBER_NAME) or link.text(), "images": [_image(around)]}


def c_members(root: Element) -> Iterator[dict]:
    """H1, H2: artist links; the first div has the name, else the image's alternative text."""
    for number, link in _links(root, "/s/s46/artist/", C_ARTIST):
        image = link.first("img")
        name = _text(link, "div") or (image.attrs.get("alt", "") if image is not None else "")
        yield {"id": number, "member_name": name, "images": [_image(link)]}


def a_list(root: Element) -> Iterator[dict]:
    """H3: the articles of a list page of site A."""
    for article in root.select(A_LIST):
        link = article.first(DETAIL_LINK)
        found = DETAIL_ID.search(link.attrs.get("href", "")) if link is not None else None
        if found:
            yield {"id": found[1], "title": _text(article, A_TITLE), "date_text": _text(article, A_DATE), "member_name": _text(article, A_NAME), "images": [_image(article)]}


def c_list(root: Element) -> Iterator[dict]:
    """H3: the boxes of a list page of site C; the thumbnail is a CSS background."""
    for box in root.select(C_LIST):
        link = box.first(DETAIL_LINK)
        found = DETAIL_ID.search(link.attrs.get("href", "")) if link is not None else None
        if found:
            span = box.first("span.img")
            yield {"id": found[1], "title": _text(box, C_LIST_TITLE), "date_text": _text(box, ".date"), "member_name": _text(box, ".name"), "style": span.attrs.get("style", "") if span is not None else ""}


def a_detail(root: Element) -> Iterator[dict]:
    """H4: a post of site A."""
    name = root.first(f"{A_NAME} a")
    member = A_CATEGORY.search(name.attrs.get("href", "")) if name is not None else None
    body = root.first(A_TEXT)
    yield {"title": _text(root, A_TITLE), "date_text": _text(root, f"{A_DATE} time"), "member_name": name.text() if name is not None else "", "member_id": member[1] if member else "", "content": body.inner_html() if body is not None else "", "images": [x.attrs.get("src", "") for x in body.select("img")] if body is not None else []}


def c_detail(root: Element) -> Iterator[dict]:
    """H4: a post of site C; the page's metadata stand in for missing parts."""
    title = root.first('meta[property="og:title"]')
    body = next((x for x in map(root.first, C_CONTENT) if x is not None), None)
    images = [x.attrs.get("src", "") for x in body.select("img")] if body is not None else []
    if not any(images):
        shared = root.first('meta[property="og:image"]')
        images = [shared.attrs.get("content", "")] if shared is not None else []
    yield {"title": title.attrs.get("content", "") if title is not None else _text(root, C_TITLE), "date_text": _text(root, C_DATE), "member_name": _text(root, C_NAME), "content": body.inner_html() if body is not None else "", "images": images}


def pages(spark: SparkSession, path: str) -> DataFrame:
    """(page, status, html) of landed files; a file on disk was answered with 200."""
    rows = whole_files(spark, path)
    return rows.select(F.col("_metadata.file_path").alias("page"), F.lit(200).alias("status"), F.col("value").alias("html"))


def extract(rows: DataFrame, extractor: Callable[[Element], Iterator[dict]], keep: tuple[str, ...] = ("page",)) -> DataFrame:
    """(kept columns, pos, fields of ``FIELDS``) for everything the extractor finds; null pages give nothing."""
    source = rows.select(*keep, F.coalesce("html", F.lit("")).alias("html"))
    kinds = ", ".join(f"{n} {t}" for n, t in source.dtypes if n != "html")

    def run(batches):
        for batch in batches:
            at, pos, found = [], [], []
            for k, html in enumerate(batch.column(len(keep)).to_pylist()):
                for n, item in enumerate(extractor(parse(html))):
                    at.append(k)
                    pos.append(n)
                    found.append(item)
            kept = batch.select(list(keep)).take(pa.array(at, pa.int64()))
            columns = [pa.array([x.get(f) or [] for x in found], pa.list_(pa.string())) if f == "images" else pa.array([x.get(f, "") for x in found], pa.string()) for f in FIELDS]
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(pos, pa.int32()), *columns], names=[*keep, "pos", *FIELDS])

    fields = ", ".join(f"{f} {'array<string>' if f == 'images' else 'string'}" for f in FIELDS)
    return source.mapInArrow(run, f"{kinds}, pos int, {fields}")


@dataclass(frozen=True)
class Site:
    """What the engine knows of a site."""

    name: str
    base: str
    members: Callable | None
    listed: Callable | None
    detail: Callable | None

    @property
    def accounts(self) -> tuple[str, ...]:
        return GROUP_ACCOUNTS.get(self.name, ())


def site(name: str, base: str) -> Site:
    """The extractors of a site; an unknown one is an error."""
    table = {"A": (a_members, a_list, a_detail), "B": (None, None, None), "C": (c_members, c_list, c_detail)}
    if name not in table:
        raise ValueError(f"unsupported site: {name}")
    return Site(name, base, *table[name])


def members(rows: DataFrame, where: Site) -> DataFrame:
    """(id, name) of members, first wins after validation."""
    if where.name == "B":
        return first_wins(jsonp.members(rows.withColumnRenamed("html", "value"), where.base).select("id", "name", "page", "pos"), ["id"], reading_order())
    found = extract(rows, where.members).select("id", F.col("member_name").alias("name"), "page", "pos")
    return first_wins(found.where(filled(F.col("name")) & no_group_account(F.col("name"), where.accounts)), ["id"], reading_order())


def member_images(rows: DataFrame, where: Site, diary: DataFrame | None = None) -> DataFrame:
    """(id, name, thumbnail_url); site A unites its artist page with its ``diary`` page, the former preferred.

    Rows without name or image are dropped before the first one wins, so an
    imageless link hides no later one.
    """
    if where.name == "B":
        found = jsonp.members(rows.withColumnRenamed("html", "value"), where.base)
        return first_wins(found, ["id"], reading_order())

    def valid(found: DataFrame) -> DataFrame:
        named = found.select("id", F.col("member_name").alias("name"), S.normalize_url(F.get("images", F.lit(0)), where.base).alias("thumbnail_url"), "page", "pos")
        return named.where(filled(F.col("name"), F.col("thumbnail_url")) & no_group_account(F.col("name"), where.accounts))

    first = valid(extract(rows, a_artists if where.name == "A" else c_members))
    if diary is None:
        return first_wins(first, ["id"], reading_order())
    return ordered_union(first, valid(extract(diary, a_diary_members)), ["id"], reading_order())


def _shaped(found: DataFrame, where: Site) -> DataFrame:
    images = F.filter("images", lambda u: u != "")
    listed = F.when(F.col("style") != "", F.filter(F.array(S.background_url("style")), lambda u: u != "")).otherwise(images)
    return found.withColumns(
        {
            "title": S.strip(S.cut_title_suffix("title") if where.name == "C" else F.col("title")),
            "published_at": S.site_datetime("date_text"),
            "content": S.normalize_html_urls("content", where.base),
            "images": F.transform(listed, lambda u: S.normalize_url(u, where.base)),
        }
    ).drop("style")


def blog_list(rows: DataFrame, where: Site, author: str | None = None, max_pages: int | None = None) -> DataFrame:
    """Posts of list pages, first wins; site C's featured posts of other authors are dropped before."""
    if max_pages is not None:
        first = rows.select("page").distinct().orderBy(natural(), "page").limit(max_pages)
        rows = rows.join(first, "page", "left_semi")
    if where.name == "B":
        return jsonp.blogs(rows.withColumnRenamed("html", "value"), where.base, content=False)
    found = _shaped(extract(rows, where.listed), where)
    if author is not None:
        found = found.where(same_author(F.col("member_name"), F.lit(author)))
    url = F.concat(F.lit(f"{where.base}/diary/detail/"), F.col("id"))
    return first_wins(found.withColumn("url", url), ["id"], reading_order())


def blog_details(rows: DataFrame, where: Site) -> DataFrame:
    """(id, outcome, fields) of detail pages (id, status, html); gone and failed ones keep only their outcome."""
    routed = rows.withColumn("outcome", route(F.col("status")))
    keyed = routed.where("outcome = 'ok'").select(F.col("id").alias("blog_id"), "html")
    found = _shaped(extract(keyed, where.detail, ("blog_id",)), where).drop("id", "pos").withColumnRenamed("blog_id", "id").withColumn("outcome", F.lit("ok"))
    return found.unionByName(routed.where("outcome <> 'ok'").select("id", "outcome"), allowMissingColumns=True)


def metadata_of(found: DataFrame, *others: str) -> DataFrame:
    """(id, thumbnail, published_at, title), null where unknown, and ``others`` of ``blog_details``."""
    return found.select("id", F.get("images", F.lit(0)).alias("thumbnail"), "published_at", F.nullif("title", F.lit("")).alias("title"), *others)


def detail_metadata(rows: DataFrame, where: Site) -> DataFrame:
    """``metadata_of`` detail pages (id, status, html)."""
    return metadata_of(blog_details(rows, where))


def outcomes(rows: DataFrame) -> DataFrame:
    """(id, outcome) of detail pages (id, status); nothing is extracted, since every page that is ok gives one row."""
    return rows.select("id", route(F.col("status")).alias("outcome"))
