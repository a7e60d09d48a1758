"""Scalar rules for messages, names, URLs, dates and tokens, as native Columns.

All of them keep predicate pushdown, column pruning and code generation intact.
Deliberate deviations from naive behaviour: an unparseable date is null, never
"now"; a URL with any scheme, or a fragment, is left alone; redaction reaches
every nesting level and never changes its input.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names, file extensions, date formats and secret keys.
TYPES = {"image": "picture", "picture": "picture", "video": "video", "movie": "video", "voice": "voice"}
EXTENSIONS = ("jpg", "jpeg", "png", "gif", "webp", "m4a", "mp3", "wav", "mp4", "mov", "webm")
DEFAULT_EXTENSIONS = {"image": "jpg", "picture": "jpg", "voice": "m4a", "movie": "mp4", "video": "mp4"}
DATE_FORMATS = ("yyyy.M.d H:m", "yyyy/M/d H:m:s", "yyyy/M/d H:m", "yyyy/M/d", "yyyy.M.d")
SECRET_KEYS = ("access_token", "refresh_token", "token", "password", "secret", "cookie", "cookies", "authorization")
REDACTED = "***REDACTED***"
SITE_OFFSET = "+09:00"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _chosen(key: Column, table: dict[str, str], default: Column | str) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out.otherwise(default)


def message_type(raw: Column | str) -> Column:
    """stored type of a raw type; null and unknown types are text."""
    return _chosen(_col(raw), TYPES, "text")


def strip(text: Column | str) -> Column:
    """Unicode white space off both ends, U+3000 included."""
    return F.regexp_replace(_col(text), r"(?U)^\s+|\s+$", "")


def sanitize_name(name: Column | str) -> Column:
    """a name that is safe as a path part."""
    out = F.regexp_replace(_col(name), r"[\x00-\x1F]", "")
    out = F.regexp_replace(out, r"[/\\]", "_")
    out = F.regexp_replace(out, r"\.\.", "_")
    return strip(F.regexp_replace(out, r'[<>:"|?*]', "_"))


def url_path(url: Column | str) -> Column:
    """The path of a URL, by the generic grammar; it never fails."""
    path = F.regexp_extract(_col(url), r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*$", "")


def media_extension(url: Column | str, raw_type: Column | str) -> Column:
    """the extension in the URL's path if it is a known one, else by raw type, else bin."""
    found = F.lower(F.regexp_extract(url_path(url), r"\.([^.]*)$", 1))
    return F.when(found.isin(*EXTENSIONS), found).otherwise(_chosen(_col(raw_type), DEFAULT_EXTENSIONS, "bin"))


def jsonp_body(text: Column | str, callback: str = "res") -> Column:
    """the JSON inside ``callback(...)``, null where the text is no such call."""
    pattern = rf"(?s)^{re.escape(callback)}\((.*)\)\s*;*\s*$"
    return F.when(_col(text).rlike(pattern), F.regexp_extract(_col(text), pattern, 1))


def site_datetime(text: Column | str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """the instant of a site's local date; null if no format fits."""
    local = F.concat(strip(text), F.lit(f" {SITE_OFFSET}"))
    return F.coalesce(*(F.try_to_timestamp(local, F.lit(f"{f} XXX")) for f in formats))


def date_only(text: Column | str) -> Column:
    """Whether a site's date has no time of day, so that it compares at day precision."""
    return ~_col(text).rlike(r"\d\s+\d+:\d")


def normalize_url(url: Column | str, base: str) -> Column:
    """an absolute URL; anything with a scheme, and a fragment, stays as it is."""
    u = F.coalesce(_col(url), F.lit(""))
    return (
        F.when(u == "", "")
        .when(u.startswith("//"), F.concat(F.lit("https:"), u))
        .when(u.startswith("/"), F.concat(F.lit(base), u))
        .when(u.rlike(r"^(?:http|#|[A-Za-z][A-Za-z0-9+.-]*:)"), u)
        .otherwise(F.concat(F.lit(f"{base}/"), u))
    )


def normalize_html_urls(html: Column | str, base: str) -> Column:
    """F8: F6 on every quoted src and href."""
    root = base.replace("\\", "\\\\").replace("$", "\\$")
    out = F.regexp_replace(_col(html), r"""(src|href)=(["'])(//[^"']*)\2""", "$1=$2https:$3$2")
    out = F.regexp_replace(out, r"""(src|href)=(["'])(/(?!/)[^"']*)\2""", f"$1=$2{root}$3$2")
    return F.regexp_replace(out, r"""(src|href)=(["'])(?!http|/|#|[A-Za-z][A-Za-z0-9+.-]*:)([^"']+)\2""", f"$1=$2{root}/$3$2")


def media_path(member_dir: Column | str, raw_type: Column | str, message_id: Column | str, extension: Column | str) -> Column:
    """``<member dir>/<type or other>/<id>.<extension>``; an unknown raw type goes to other."""
    folder = _chosen(_col(raw_type), TYPES, "other")
    return F.concat_ws("/", _col(member_dir), folder, F.concat(_col(message_id).cast("string"), F.lit("."), _col(extension)))


def redact(value: Column, kind: T.DataType) -> Column:
    """the values of secret keys masked, in maps and structs of any depth."""
    if isinstance(kind, T.MapType):
        mask = F.lit(REDACTED) if isinstance(kind.valueType, T.StringType) else F.lit(None).cast(kind.valueType)
        return F.transform_values(value, lambda k, v: F.when(F.lower(k).isin(*SECRET_KEYS), mask).otherwise(redact(v, kind.valueType)))
    if isinstance(kind, T.StructType):
        fields = []
        for f in kind.fields:
            if f.name.lower() in SECRET_KEYS:
                kept = F.lit(REDACTED) if isinstance(f.dataType, T.StringType) else F.lit(None).cast(f.dataType)
                fields.append(F.when(value[f.name].isNotNull(), kept).alias(f.name))
            else:
                fields.append(redact(value[f.name], f.dataType).alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.MapType | T.StructType):
        return F.transform(value, lambda x: redact(x, kind.elementType))
    return value


def token_expiry(token: Column | str) -> Column:
    """the ``exp`` claim of a JWT in epoch seconds, unverified; null on any failure."""
    part = F.get(F.split(_col(token), r"\."), F.lit(1))
    plain = F.translate(part, "-_", "+/")
    size = F.length(plain)
    padded = F.rpad(plain, (size + F.pmod(-size, F.lit(4))).cast("int"), "=")
    decoded = F.try_to_binary(padded, F.lit("base64"))
    return F.get_json_object(decoded.cast("string"), "$.exp").try_cast("double").cast("long")


def token_remaining(token: Column | str, now: Column) -> Column:
    """seconds until expiry at ``now``, null for an unreadable token."""
    return token_expiry(token) - F.unix_timestamp(now)


def token_expired(token: Column | str, now: Column) -> Column:
    """unreadable tokens count as expired."""
    return F.coalesce(token_remaining(token, now) <= 0, F.lit(True))


def cut_title_suffix(title: Column | str) -> Column:
    """the title up to the last `` | ``."""
    return F.regexp_replace(_col(title), r"(?s)^(.*) \| .*$", "$1")


def state_key(group_id: Column | str, member_id: Column | str) -> Column:
    """``<group>_<member>``."""
    return F.concat_ws("_", _col(group_id).cast("string"), _col(member_id).cast("string"))


def first_filled(*values: Column | str) -> Column:
    """the first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(_col(v), F.lit("")) for v in values))


def seconds(milliseconds: Column | str) -> Column:
    """F16: milliseconds as seconds; zero is unknown."""
    ms = _col(milliseconds)
    return F.when(ms != 0, ms / 1000.0)


def export_clock(now: Column) -> Column:
    """an ISO 8601 instant in UTC."""
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def favorite(flag: Column | str) -> Column:
    """a missing or null flag is false."""
    return F.coalesce(_col(flag), F.lit(False))


def favorite_in(message: Column | str) -> Column:
    """F18 on a message as VARIANT: a missing flag is false, one that is null stays null, and so does what is no flag."""
    flag = F.try_variant_get(_col(message), "$.is_favorite", "variant")
    return F.when(flag.isNull(), F.lit(False)).otherwise(F.try_variant_get(_col(message), "$.is_favorite", "boolean"))


def image_sources(html: Column | str, base: str) -> Column:
    """H7: all image sources of a fragment in order, empty ones skipped, repeats kept."""
    found = F.regexp_extract_all(F.coalesce(_col(html), F.lit("")), F.lit(r"""(?i)<img\b[^>]*?\ssrc\s*=\s*["']([^"']+)["']"""), F.lit(1))
    return F.transform(found, lambda u: normalize_url(u, base))


def background_url(style: Column | str) -> Column:
    """H6: the URL of a CSS background image; empty if there is none."""
    return F.regexp_extract(_col(style), r"""background-image:\s*url\(["']?([^"')\s]+)["']?\)""", 1)
