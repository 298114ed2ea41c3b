"""Record types and the names of the columns that travel between operators."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of one item of an article's body, all nullable text.
CONTENT_FIELDS = (
    "content", "subtype", "type", "mime", "fullcaption", "imageURL", "imageHeight",
    "imageWidth", "blurb", "role", "name", "bio", "kicker",
)

CONTENT_ITEM = T.StructType([T.StructField(name, T.StringType()) for name in CONTENT_FIELDS])

ARTICLE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("article_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("published_date", T.LongType()),
    T.StructField("contents", T.ArrayType(CONTENT_ITEM)),
    T.StructField("type", T.StringType()),
    T.StructField("source", T.StringType()),
])

# Fixed values of the task: the body item that counts as prose, how many of them are
# read, how many results a query keeps, and how unlike two kept titles must be.
PARAGRAPH = "paragraph"
MAX_PARAGRAPHS = 5
TOP_K = 10
MIN_TITLE_DISTANCE = 0.5
