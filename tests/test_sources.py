"""Landed JSON, JSONP and HTML, and media headers."""

from __future__ import annotations

import datetime
import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.plans import blogs as archive
from tidemark.sources import html, jsonp, landed, media
from tidemark.sources.markup import parse

BASE = "https://b.example"


def land(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, value in files.items():
        (folder / f"{name}.json").write_text(value if isinstance(value, str) else json.dumps(value))
    return str(folder)


def test_timeline_pages(spark, tmp_path):
    path = land(tmp_path / "t", p0={"messages": [{"id": 10, "text": "new"}, {"id": 9, "text": "x", "extra": {"a": 1}}], "continuation": "c"}, p1={"messages": [{"id": 8}, {"id": 10, "text": "later"}]}, p2={"other": 1}, p3="{not json")
    rows = landed.timeline(spark, path).orderBy("id").collect()
    assert [(r["id"], r["text"]) for r in rows] == [(8, None), (9, "x"), (10, "later")]
    assert json.loads(rows[1]["raw"])["extra"] == {"a": 1}
    assert landed.corrupt(spark, path).count() == 1


def test_groups_members_and_envelopes(spark, tmp_path):
    path = land(tmp_path / "g", g=[{"id": 1, "subscription": {"state": "active"}}, {"id": 2, "subscription": {"state": "expired"}}, {"id": 3, "state": "closed"}, {"id": 4}])
    assert sorted(r["id"] for r in landed.groups(spark, path).collect()) == [1, 3]
    assert sorted(r["id"] for r in landed.groups(spark, path, True).collect()) == [1, 2, 3]
    assert landed.members(spark, land(tmp_path / "m", m=[{"id": 5, "name": "n"}])).first()["name"] == "n"
    assert landed.news(spark, land(tmp_path / "n", n={"announcements": [{"k": k} for k in range(30)]})).count() == 20
    assert landed.letters(spark, land(tmp_path / "l", n={"letters": [{"updated_at": "2024-01-01T00:00:00Z"}, {"updated_at": "2024-02-01T00:00:00Z"}]}), "2024-02-01T00:00:00Z").count() == 1
    assert landed.fc_contents(spark, land(tmp_path / "c", n={"contents": [{"organization_id": 1}, {"organization_id": 2}, {}]})).count() == 1
    assert landed.products(spark, land(tmp_path / "p", n={"products": [{"type": "a"}, {"type": "b"}]}), "b").count() == 1
    for name, key in (("tags", "tags"), ("organizations", "organizations"), ("past_messages", "messages")):
        assert getattr(landed, name)(spark, land(tmp_path / name, n={key: [{"id": 1}, {"id": 2}]})).count() == 2
    assert landed.single(spark, land(tmp_path / "s", n={"id": 7})).count() == 1
    state = land(tmp_path / "st", s={"1_2": {"last_message_id": 3, "last_sync_ts": "2024", "total_messages": 4}})
    assert landed.sync_state(spark, f"{state}/s.json").first().asDict() == {"group_id": 1, "member_id": 2, "last_message_id": 3, "last_sync_ts": "2024", "total_messages": 4, "last_sync": None}
    assert landed.sync_state(spark, f"{state}/none.json").count() == 0
    assert landed.sync_state(spark, f"{land(tmp_path / 'bad', s='no state at all')}/s.json").count() == 0


def test_stored_documents(spark, tmp_path):
    path = land(tmp_path / "d", a={"member": {"id": 1}, "total_messages": 1, "messages": [{"id": 5}]}, b="{\"half\": ")
    good, bad = landed.documents(spark, path)
    assert good.first()["messages"][0]["id"] == 5
    assert bad.count() == 1


POST = {"code": "7", "title": "t", "text": '<p><img src="/a.jpg"><a href="/x">y</a></p>', "date": "2025/11/03 21:09:45", "link": "l", "name": "n", "arti_code": "m", "img": "/a.jpg"}


def calls(spark, *values):
    return spark.createDataFrame([(f"p{k}", v) for k, v in enumerate(values)], "page string, value string")


def test_jsonp_posts(spark):
    body = lambda *posts: f"res({json.dumps({'count': '1', 'data': list(posts)})});"
    rows = calls(spark, body(POST, POST | {"code": ""}), body(POST | {"title": "second"}, POST | {"code": "8", "img": "//c/b.jpg", "date": "?"}), "broken", "res({)")
    found = jsonp.blogs(rows, BASE).orderBy("id").collect()
    assert [(r["id"], r["title"], r["images"]) for r in found] == [("7", "t", [f"{BASE}/a.jpg"]), ("8", "t", ["https://c/b.jpg", f"{BASE}/a.jpg"])]
    assert f'href="{BASE}/x"' in found[0]["content"] and found[1]["published_at"] is None
    assert found[0]["published_at"] == datetime.datetime(2025, 11, 3, 12, 9, 45)
    assert sorted(r["reason"] for r in jsonp.parse(rows, html.jsonp.schemas.JSONP_BLOG)[1].collect()) == ["not JSON", "not a callback"]
    assert jsonp.detail(rows, BASE, "8").count() == 1 and jsonp.detail(rows, BASE, "9").count() == 0
    members = body({"code": "001", "name": "a", "graduation": "NO", "img": "/i"}, {"code": "46", "name": "g", "graduation": "NO"}, {"code": "2", "name": "b", "graduation": "YES"}, {"code": "3", "name": "c"})
    assert [tuple(r)[:3] for r in jsonp.members(calls(spark, members), BASE).collect()] == [("001", "a", f"{BASE}/i")]


def web(spark, *pages, status=200):
    return spark.createDataFrame([(f"p{k}", status, h) for k, h in enumerate(pages)], "page string, status int, html string")


A_LIST = '<article class="p-blog-article"><a href="/s/diary/detail/{0}"><div class="c-blog-article__title">T{0}</div><div class="c-blog-article__date">{1}</div><div class="c-blog-article__name">花田ここ</div><img src="/i{0}.jpg"></a></article>'
A_DETAIL = '<div class="c-blog-article__title"> T </div><div class="c-blog-article__date"><time>2024.1.23 16:03</time></div><div class="c-blog-article__name"><a href="?ct=40">n</a></div><div class="c-blog-article__text">Hi <b>x</b><br><img src="/1.jpg"><img src="//c/2.jpg"></div>'


def test_site_a(spark):
    a = html.site("A", BASE)
    diary = web(spark, '<div><a href="/list?ct=40">花田ここ</a></div><div><a href="/list?ct=41"></a><p class="name">青木司</p></div><a href="?ct=40">other</a><a href="?ct=1">日向坂46</a>')
    assert sorted((r["id"], r["name"]) for r in html.members(diary, a).collect()) == [("40", "花田ここ"), ("41", "青木司")]
    artists = web(spark, '<ul><li><a href="/artist/40">no image</a></li><li><a href="/artist/40"><img src="/40.jpg"><p>花田</p></a></li></ul>')
    more = web(spark, '<div><a href="?ct=999"><img src="/p.jpg"><span class="p-blog-member__name">ミケ</span></a></div><div><a href="?ct=40"><img src="/other.jpg">x</a></div>')
    assert sorted((r["id"], r["thumbnail_url"]) for r in html.member_images(artists, a, more).collect()) == [("40", f"{BASE}/40.jpg"), ("999", f"{BASE}/p.jpg")]
    lists = web(spark, A_LIST.format(3, "2026.1.15 12:00") + A_LIST.format(2, "2020.1.1 12:00"), A_LIST.format(3, "2019.1.1") + A_LIST.format(1, "2026.1.1"))
    posts = archive.metadata(lists, a).orderBy("id").collect()
    assert [(r["id"], r["title"], r["images"]) for r in posts] == [(k, f"T{k}", [f"{BASE}/i{k}.jpg"]) for k in "123"]
    assert [r["id"] for r in archive.metadata(lists, a, datetime.datetime(2025, 1, 1)).collect()] == ["3"]
    assert [r["id"] for r in archive.metadata(lists, a, max_pages=1).orderBy("id").collect()] == ["2", "3"]
    details = spark.createDataFrame([("3", 200, A_DETAIL), ("2", 404, ""), ("1", 500, "")], "id string, status int, html string")
    full, rejects = archive.full(lists, details, a)
    row = full.first()
    assert (row["id"], row["title"], row["member_id"], row["images"]) == ("3", "T", "40", [f"{BASE}/1.jpg", "https://c/2.jpg"])
    assert row["content"].startswith("Hi <b>x</b>") and f'src="{BASE}/1.jpg"' in row["content"]
    assert sorted(map(tuple, rejects.collect())) == [("1", "error"), ("2", "gone")]


C_BOX = '<li class="box"><a href="/s/s46/diary/detail/{0}"><span class="img" style="background-image: url(\'/t{0}.jpg\')"></span><p class="date">{1}</p><h3>T{0}</h3><p class="name">{2}</p></a></li>'


def test_site_c(spark):
    c = html.site("C", BASE)
    page = web(spark, '<a href="/s/s46/artist/01"><img src="/01.jpg" alt="alt"><div>川上 月夜</div><div>kana</div></a><a href="/s/s46/artist/02"><img src="/02.jpg" alt="alt2"></a><a href="/s/s46/artist/03"><div>x</div></a>')
    assert sorted((r["id"], r["name"]) for r in html.members(page, c).collect()) == [("01", "川上 月夜"), ("02", "alt2"), ("03", "x")]
    assert sorted(r["id"] for r in html.member_images(page, c).collect()) == ["01", "02"]
    lists = web(spark, C_BOX.format(9, "2026/1/15", "someone else") + C_BOX.format(8, "2026/1/15", "川上　月夜") + C_BOX.format(7, "2026/1/14", "川上 月夜"))
    posts = archive.metadata(lists, c, author="川上月夜").orderBy("id").collect()
    assert [(r["id"], r["images"]) for r in posts] == [("7", [f"{BASE}/t7.jpg"]), ("8", [f"{BASE}/t8.jpg"])]
    detail = '<meta property="og:title" content="A | B | Site"><meta property="og:image" content="/og.jpg"><div class="box-article"><p>Body &amp; more.</p></div><div class="blog-foot"><p class="date">2026/01/15 10:00</p></div>'
    rows = spark.createDataFrame([("8", 200, detail), ("7", 410, None)], "id string, status int, html string")
    meta = html.detail_metadata(rows, c).orderBy("id").collect()
    assert (meta[1]["thumbnail"], meta[1]["title"], meta[1]["published_at"]) == (f"{BASE}/og.jpg", "A | B", datetime.datetime(2026, 1, 15, 1))
    assert meta[0]["title"] is None
    full, rejects = archive.full(lists, rows, c, author="川上月夜")
    assert [r["id"] for r in full.collect()] == ["8"] and [tuple(r) for r in rejects.collect()] == [("7", "gone")]


def test_unknown_site():
    with pytest.raises(ValueError):
        html.site("Z", BASE)


def test_markup_is_tolerant():
    root = parse('<div class="a b"><p>one<p>two<br><img src="x"></div><ul><li>x</ul></span>tail')
    assert root.first("div.b").text() == "onetwo"
    assert root.first('img[src="x"]') is not None and root.first("ul li").text() == "x"
    assert [x.name for x in root.select("p, li")] == ["p", "p", "li"]


def png(width, height):
    head = b"IHDR" + struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + head + struct.pack(">I", zlib.crc32(head))


def test_media_probe(spark, tmp_path):
    jpeg = b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"ab" + b"\xff\xc0" + struct.pack(">HBHH", 17, 8, 50, 100) + b"\0" * 12
    files = {"a.png": png(200, 150), "b.gif": b"GIF89a" + struct.pack("<HH", 3, 4), "c.jpg": jpeg, "d.jpg": jpeg[:9], "e.txt": b"text", "f.png": b""}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    found = {r["path"].rsplit("/", 1)[1]: (r["width"], r["height"]) for r in media.probe(spark, str(tmp_path)).collect()}
    assert found == {"a.png": (200, 150), "b.gif": (3, 4), "c.jpg": (100, 50), "d.jpg": (None, None), "e.txt": (None, None)}  # a file without bytes is no file yet
    assert media.listing(spark, str(tmp_path)).where(F.col("length") > 0).count() == 5


def test_jpeg_frame_header_behind_long_segments(spark, tmp_path):
    frame = b"\xff\xc0" + struct.pack(">HBHH", 17, 8, 50, 100) + b"\0" * 10
    (tmp_path / "a.jpg").write_bytes(b"\xff\xd8" + (b"\xff\xe1\xff\xff" + b"\0" * 65_533) * 3 + frame)
    (tmp_path / "b.jpg").write_bytes(b"\xff\xd8" + (b"\xff\xe1\xff\xff" + b"\0" * 65_533) * 3)
    found = {r["path"].rsplit("/", 1)[1]: (r["width"], r["height"]) for r in media.probe(spark, str(tmp_path)).collect()}
    assert found == {"a.jpg": (100, 50), "b.jpg": (None, None)}


def movie(kinds=("vide", "soun"), size=(640, 360), scale=1000, length=2500, last=True):
    box = lambda kind, *parts: struct.pack(">I", 8 + sum(map(len, parts))) + kind + b"".join(parts)

    def track(kind):
        entry = b"\0" * 8 + struct.pack(">I", 86) + b"avc1" + b"\0" * 24 + struct.pack(">HH", *size) + b"\0" * 50
        stbl = box(b"stbl", box(b"stsd", entry)) if kind == "vide" else box(b"stbl")
        return box(b"trak", box(b"tkhd", b"\0" * 76 + struct.pack(">II", 1 << 16, 2 << 16)), box(b"mdia", box(b"hdlr", b"\0" * 8 + kind.encode() + b"\0" * 12), box(b"minf", stbl)))

    head = box(b"mvhd", b"\0" * 12 + struct.pack(">II", scale, length) + b"\0" * 80)
    moov = box(b"moov", head, *map(track, kinds))
    return box(b"ftyp", b"isom\0\0\0\0") + (box(b"mdat", b"x" * 70_000) + moov if last else moov + box(b"mdat", b"x"))


def test_video_and_audio_measures(spark, tmp_path):
    files = {"a.mp4": movie(), "b.mp4": movie(("vide",), (8, 9), 90_000, 45_000, last=False), "c.m4a": movie(("soun",)), "d.mp4": movie()[:100], "e.mov": b"\0\0\0\x08ftyp" + b"\0\0\0\x10moovshortbox", "f.json": b"{}"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    row = lambda r: (r["path"].rsplit("/", 1)[1], r["width"], r["height"], r["media_duration"], r["is_muted"])
    found = sorted(row(r) for r in media.probe(spark, str(tmp_path)).collect())
    assert found == [("a.mp4", 640, 360, 2.5, False), ("b.mp4", 8, 9, 0.5, True), ("c.m4a", None, None, 2.5, None), ("d.mp4", None, None, None, None), ("e.mov", None, None, None, None), ("f.json", None, None, None, None)]
    paths = {r["path"].rsplit("/", 1)[1]: r["path"] for r in media.probe(spark, str(tmp_path)).collect()}
    types = spark.createDataFrame([(paths["a.mp4"], "video"), (paths["b.mp4"], "picture"), (paths["c.m4a"], "voice")], "path string, type string")
    assert sorted(row(r) for r in media.probe(spark, str(tmp_path), types).collect()) == [("a.mp4", 640, 360, 2.5, False), ("b.mp4", 8, 9, None, None), ("c.m4a", None, None, 2.5, None)]


def test_a_video_of_three_gigabytes_is_read_by_ranges(spark, tmp_path):
    """Sparse files with the movie header behind and before 3 GB of data; no content is in any row."""
    moov = movie()[70_000 + 24 :]
    assert moov[4:8] == b"moov"
    size = 3 << 30
    wide = struct.pack(">I4sQ", 1, b"mdat", size)  # a box of 64-bit size
    for name, front, back in (("last.mp4", b"", moov), ("first.mp4", moov, b""), ("cut.mp4", b"", moov[:50])):
        with (tmp_path / name).open("wb") as f:
            f.write(struct.pack(">I4s8s", 16, b"ftyp", b"isom") + front + wide)
            f.seek(size - 16, 1)
            f.write(back)
            f.truncate()
    found = {r["path"].rsplit("/", 1)[1]: r for r in media.headers(spark, str(tmp_path), 1).collect()}
    for name in ("last.mp4", "first.mp4"):
        r = found[name]
        assert (r["width"], r["height"], r["media_duration"], r["is_muted"]) == (640, 360, 2.5, False)
        assert r["length"] > size and r["bytes_read"] < 40_000
    assert found["cut.mp4"]["media_duration"] is None
    assert media.headers(spark, str(tmp_path), 1).rdd.getNumPartitions() == 3
    probed = {r["path"]: r["media_duration"] for r in media.probe(spark, f"file://{tmp_path}").collect()}
    assert probed == {f"file:{tmp_path}/{n}": d for n, d in (("last.mp4", 2.5), ("first.mp4", 2.5), ("cut.mp4", None))}


def test_ranges_and_whole_files_give_the_same(spark, tmp_path):
    files = {"a.mp4": movie(), "b.MP4": movie(("vide",), (8, 9), 90_000, 45_000, last=False), "c.png": png(3, 4), "d.txt": b"x", "_hidden.png": png(1, 1), "e.gif": b"GIF89a"}
    (tmp_path / "below").mkdir()
    for k, (name, data) in enumerate(files.items()):
        (tmp_path / ("below" if k % 2 else ".") / name).write_bytes(data)
    one, two = (sorted(map(tuple, f(spark, str(tmp_path)).collect())) for f in (media.probe, media._whole))
    assert one == two and len(one) == 5


def test_variants_keep_types_and_tell_missing_from_null(spark, tmp_path):
    path = land(tmp_path / "v", p={"messages": [{"id": 1, "new": {"n": 2.5}, "x": None}, {"id": 2, "new": "text"}]})
    rows = landed.variants(spark, path, "messages")
    get = lambda place, kind: F.try_variant_get("item", place, kind)
    shown = rows.select(get("$.id", "long").alias("id"), F.schema_of_variant(get("$.new", "variant")).alias("type"), get("$.new.n", "double").alias("n"), F.is_variant_null(get("$.x", "variant")).alias("x")).orderBy("id")
    assert [tuple(r) for r in shown.collect()] == [(1, "OBJECT<n: DECIMAL(2,1)>", 2.5, True), (2, "STRING", None, False)]


def test_written_markup_shows_what_was_shown():
    for inner in ("<p>1 &lt; 2 &amp;&amp; &lt;script&gt;x&lt;/script&gt;</p>", '<img alt="say &quot;hi&quot; &amp; \'bye\'" src="/a?b=1&amp;c=2"/>', "<b title='a \"b\"'>x</b>", "<!-- note --><br/>text", "<script>if (a < b && c) {}</script>"):
        body = parse(f'<div class="x">{inner}</div>').first(".x")
        assert body.inner_html() == inner
        assert parse(body.outer_html()).first(".x").inner_html() == inner
    deep = parse("<p>" * 10_000 + "x" + "</b>" * 10_000)
    assert deep.first("p").inner_html() == "<p>" * 9_999 + "x" + "</p>" * 9_999 and deep.first("p").outer_html().count("</p>") == 10_000


def test_pages_are_read_by_number(spark, tmp_path):
    path = land(tmp_path / "t", **{f"page-{k}": {"messages": [{"id": 1, "text": f"from {k}"}, {"id": 100 + k}]} for k in (1, 2, 9, 10, 11)})
    assert landed.timeline(spark, path).where("id = 1").first()["text"] == "from 11"  # the last page wins
    news = land(tmp_path / "n", **{f"{k}": {"announcements": [{"k": k}]} for k in (10, 9, 2, 100)})
    assert [json.loads(r["raw"])["k"] for r in landed.news(spark, news, 3).collect()] == [2, 9, 10]
    posts = calls(spark, *(f"res({json.dumps({'data': [POST | {'title': str(k)}]})})" for k in range(12))).where("page <> 'p0' and page <> 'p1'")
    assert jsonp.blogs(posts, BASE).first()["title"] == "2"  # the first page wins
    lists = web(spark, *(A_LIST.format(k, f"20{30 - k}.1.1 12:00") for k in range(12)))
    a = html.site("A", BASE)
    assert sorted(int(r["id"]) for r in html.blog_list(lists, a, max_pages=3).collect()) == [0, 1, 2]
    assert sorted(int(r["id"]) for r in archive.metadata(lists, a, datetime.datetime(2020, 1, 1)).collect()) == list(range(11))
