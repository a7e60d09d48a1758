"""Scalar rules against literals and small plain models."""

from __future__ import annotations

import base64
import json
import re
from urllib.parse import urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S

BASE = "https://b.example"


def values(spark, inputs, column, kind="string"):
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(inputs)], f"k int, x {kind}")
    return [r[0] for r in rows.orderBy("k").select(column).collect()]


def test_message_type(spark):
    assert values(spark, ["image", "picture", "video", "movie", "voice", "text", None, "Image", "x"], S.message_type("x")) == ["picture", "picture", "video", "video", "voice", "text", "text", "text", "text"]


def plain_name(name):
    name = "".join(c for c in name if ord(c) > 0x1F).replace("/", "_").replace("\\", "_")
    while ".." in name:
        name = name.replace("..", "_")
    return re.sub(r'[<>:"|?*]', "_", name).strip()


def test_sanitize_literals(spark):
    given_ = [r"..\..\etc", "a/b\\c", '<>:"|?*', "a\x00b\x1fc", "  山田 太郎　", "...", "", None]
    assert values(spark, given_, S.sanitize_name("x")) == ["____etc", "a_b_c", "_______", "abc", "山田 太郎", "_.", "", None]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.sampled_from("ab./\\ .:<>|?*\t　\x01é"), max_size=12), min_size=40, max_size=40))
def test_sanitize_model(spark, names):
    assert values(spark, names, S.sanitize_name("x")) == [plain_name(n) for n in names]


@pytest.mark.parametrize(
    ("url", "kind", "expected"),
    [("https://h/file.jpg", "picture", "jpg"), ("https://h/file.mp4?query=1", "movie", "mp4"), ("https://h/file", "voice", "m4a"), (None, "image", "jpg"), (None, "text", "bin"), ("https://h.com/a.exe", "video", "mp4"), ("https://h/A.PNG#x.gif", "text", "png"), ("//h/a.b/c.webm;v=1", "x", "webm"), ("", None, "bin")],
)
def test_media_extension(spark, url, kind, expected):
    row = spark.createDataFrame([(url, kind)], "u string, t string").select(S.media_extension("u", "t")).first()
    assert row[0] == expected


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.sampled_from("ab./:?#h"), max_size=14), min_size=40, max_size=40))
def test_url_path_model(spark, urls):
    expected = []
    for u in urls:
        try:
            expected.append(urlparse(u).path)
        except ValueError:
            expected.append(None)
    found = values(spark, urls, S.url_path("x"))
    # the grammar's scheme may start with any character, the library's only with a letter
    assert all(a == b for u, a, b in zip(urls, found, expected, strict=True) if b is not None and not re.match(r"[^A-Za-z/?#]|[A-Za-z]*\.[^/?#]*:|:", u) and ":" not in u)


def test_jsonp(spark):
    texts = ['res({"a":1})', 'res({"a":1});', 'res({"a":\n1}) ; ', ' res({"a":1})', 'res({"a":1}', 'cb({"a":1})', "", None, "res()"]
    assert values(spark, texts, S.jsonp_body("x")) == ['{"a":1}', '{"a":1}', '{"a":\n1}', None, None, None, None, None, ""]


def test_dates(spark):
    texts = ["2024.1.23 16:03", "2025/11/03 21:09:45", "2026/1/8 7:05", "2026/1/8", "2026.12.31", " 2024.1.23 16:03　", "soon", "", None, "2026/13/1"]
    found = values(spark, texts, F.date_format(S.site_datetime("x"), "yyyy-MM-dd HH:mm:ss"))
    assert found == ["2024-01-23 07:03:00", "2025-11-03 12:09:45", "2026-01-07 22:05:00", "2026-01-07 15:00:00", "2026-12-30 15:00:00", "2024-01-23 07:03:00", None, None, None, None]
    assert values(spark, texts[:5], S.date_only("x")) == [False, False, False, True, True]


def test_urls(spark):
    texts = ["//c/x", "/x", "x/y.png", "http://h/x", "https://h", "#top", "mailto:a@b", "data:image/png;base64,x", "", None]
    assert values(spark, texts, S.normalize_url("x", BASE)) == ["https://c/x", f"{BASE}/x", f"{BASE}/x/y.png", "http://h/x", "https://h", "#top", "mailto:a@b", "data:image/png;base64,x", "", ""]
    html = """<a href="/a">x</a><img src='//c/i.png'><a href="rel/b"></a><a href="http://h">y</a><a href="#t"></a><a href="mailto:x"></a><img src=""><a href='/q"x'></a>"""
    assert values(spark, [html], S.normalize_html_urls("x", BASE)) == [f"""<a href="{BASE}/a">x</a><img src='https://c/i.png'><a href="{BASE}/rel/b"></a><a href="http://h">y</a><a href="#t"></a><a href="mailto:x"></a><img src=""><a href='/q"x'></a>"""]


def test_images_and_background(spark):
    html = '<p><img class="a" src="/1.png"><img src=""><IMG alt="x" src=\'//c/2.png\'/><img src="/1.png"></p>'
    assert values(spark, [html, None], S.image_sources("x", BASE)) == [[f"{BASE}/1.png", "https://c/2.png", f"{BASE}/1.png"], []]
    assert values(spark, ["background-image: url('/a.jpg');", "background-image:url(/b.jpg)", "x"], S.background_url("x")) == ["/a.jpg", "/b.jpg", ""]


def jwt(claims):
    return "h." + base64.urlsafe_b64encode(json.dumps(claims).encode()).decode().rstrip("=") + ".s"


def test_tokens(spark):
    tokens = [jwt({"exp": 1700000000 + k, "pad": "x" * k}) for k in range(4)] + ["", None, "garbage", "a.b", "a.%%%.c", jwt({"n": 1}), jwt({"exp": "never"})]
    assert values(spark, tokens, S.token_expiry("x")) == [1700000000, 1700000001, 1700000002, 1700000003, None, None, None, None, None, None, None]
    now = F.timestamp_seconds(F.lit(1700000001))
    assert values(spark, tokens[:5], S.token_expired("x", now)) == [True, True, False, False, True]
    assert values(spark, tokens[:5], S.token_remaining("x", now)) == [-1, 0, 1, 2, None]


def test_redaction(spark):
    kind = T.StructType.fromDDL("token string, user string, headers map<string,string>, deep struct<x:array<map<string,string>>,Cookie:string>")
    row = spark.createDataFrame([(("t", "u", {"Authorization": "a", "Accept": "b"}, ([{"SECRET": "s", "k": "v"}], "c")), None), ((None, None, None, None), None)], T.StructType([T.StructField("r", kind), T.StructField("n", T.StringType())]))
    first, second = row.select(S.redact(F.col("r"), kind).alias("r")).collect()
    assert first["r"].asDict(True) == {"token": S.REDACTED, "user": "u", "headers": {"Authorization": S.REDACTED, "Accept": "b"}, "deep": {"x": [{"SECRET": S.REDACTED, "k": "v"}], "Cookie": S.REDACTED}}
    assert second["r"].asDict(True) == {"token": None, "user": None, "headers": None, "deep": None}
    assert row.first()["r"]["token"] == "t"


def test_small_rules(spark):
    assert values(spark, ["a | b | c", "a", "", "a\n | x"], S.cut_title_suffix("x")) == ["a | b", "a", "", "a\n"]
    assert values(spark, [0.0, 1500.0, None], S.seconds("x"), "double") == [None, 1.5, None]
    assert values(spark, [True, False, None], S.favorite("x"), "boolean") == [True, False, False]
    assert spark.range(1).select(S.first_filled(F.lit(""), F.lit(None), F.lit("u")), S.state_key(F.lit(1), F.lit(2))).first()[:] == ("u", "1_2")
    assert spark.range(1).select(S.media_path(F.lit("d"), F.lit("movie"), F.lit(7), F.lit("mp4")), S.media_path(F.lit("d"), F.lit("odd"), F.lit(7), F.lit("bin"))).first()[:] == ("d/video/7.mp4", "d/other/7.bin")
    assert spark.range(1).select(S.export_clock(F.timestamp_seconds(F.lit(0)))).first()[0] == "1970-01-01T00:00:00.000Z"
    plan = spark.createDataFrame([("a",)], "x string").select(S.sanitize_name("x"), S.token_expiry("x"), S.site_datetime("x"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
