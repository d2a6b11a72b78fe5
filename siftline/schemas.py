"""Explicit schemas; nothing in the package infers one from data."""

from pyspark.sql import types as T

STRING, BOOL, INT, LONG, TIME = T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.TimestampType()
STRINGS = T.ArrayType(STRING)


def row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def many(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(row(**fields))


RECORD = row(
    source=STRING, source_record_id=STRING, identity=STRING, text=STRING, url=STRING, published_at=TIME, display_name=STRING,
    username=STRING, business_name=STRING, first_name=STRING, name_source=STRING, bio=STRING, profile_url=STRING,
    name_reliable=BOOL, urls=STRINGS, metadata=T.MapType(STRING, STRING))

TERMS = row(grp=STRING, kind=STRING, ord=INT, term=STRING)

SEMANTIC = row(
    is_insurance_relevant=BOOL, is_consumer=BOOL, is_advertisement=BOOL, is_broker_or_agent=BOOL, south_africa_signal=BOOL,
    intent_level=STRING, product_type=STRING, score=INT, reason=STRING)

COMMENT_PAGE = row(items=many(id=STRING, snippet=row(
    publishedAt=STRING, authorChannelId=row(value=STRING), authorChannelUrl=STRING, authorDisplayName=STRING,
    textOriginal=STRING, textDisplay=STRING)))

_BODY = row(
    createdAt=STRING, text=STRING, facets=many(features=many(**{"$type": STRING, "uri": STRING})),
    embed=row(external=row(uri=STRING)))

POST_PAGE = row(posts=many(uri=STRING, author=row(did=STRING, handle=STRING, displayName=STRING), record=_BODY))

COMMIT_EVENT = row(did=STRING, time_us=LONG, kind=STRING,
                   commit=row(operation=STRING, collection=STRING, rkey=STRING, record=_BODY))

CAPTURE = T.MapType(STRING, STRING)

ENVELOPE = row(
    batch_id=STRING, campaign_id=STRING, checksum=STRING, spreadsheet_id=STRING, drive_folder_id=STRING, shard_rows=INT,
    fields=STRINGS, items=many(lead_id=LONG, tab=STRING, row=INT, values=STRINGS))

SNAPSHOT = row(spreadsheet_sha256=STRING, captured_at=STRING, tabs=T.MapType(STRING, INT))
