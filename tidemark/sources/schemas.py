"""Schemas of the landed records, as far as the engine reads their fields; unknown fields stay in ``raw``."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType


def _struct(**fields) -> StructType:
    return StructType([StructField(k, v, True) for k, v in fields.items()])


_s, _l, _b, _i = StringType(), LongType(), BooleanType(), IntegerType()

MESSAGE = _struct(id=_l, member_id=_l, published_at=_s, type=_s, text=_s, is_favorite=_b, file=_s, thumbnail=_s)
NORMALIZED = _struct(id=_l, timestamp=_s, type=_s, is_favorite=_b, content=_s)
MEDIA = _struct(media_file=_s, width=_i, height=_i, media_duration=DoubleType(), is_muted=_b)
STORED = StructType([StructField("group_id", _l), StructField("member_id", _l), *NORMALIZED.fields, StructField("raw_type", _s), StructField("media_url", _s), *MEDIA.fields])
GROUP = _struct(id=_l, name=_s, state=_s, subscription=_struct(state=_s), thumbnail=_s)
MEMBER = _struct(id=_l, name=_s, portrait=_s, thumbnail=_s, phone_image=_s)
STATE = _struct(group_id=_l, member_id=_l, last_message_id=_l, last_sync_ts=_s, total_messages=_l, last_sync=_s)
COUNTS = _struct(text=_l, video=_l, picture=_l, voice=_l)
DOCUMENT = _struct(exported_at=_s, member=_struct(id=_l, name=_s, group_id=_l, group_name=_s, portrait=_s, thumbnail=_s, phone_image=_s, group_thumbnail=_s), total_messages=_l, message_type_counts=COUNTS, messages=ArrayType(StructType([*NORMALIZED.fields, *MEDIA.fields])))
BLOG = _struct(id=_s, title=_s, content=_s, published_at=TimestampType(), date_text=_s, url=_s, images=ArrayType(_s), member_id=_s, member_name=_s)
MEMBER_INFO = _struct(id=_s, name=_s, thumbnail_url=_s)
JSONP_BLOG = _struct(code=_s, title=_s, text=_s, date=_s, link=_s, name=_s, arti_code=_s, img=_s)
JSONP_MEMBER = _struct(code=_s, name=_s, graduation=_s, img=_s)
EMPTY = StructType([])
