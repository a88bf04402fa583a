"""Declared schemas of the feeds and tables.

The metadata schema is kept as a JSON-shaped dict and turned into a ``StructType`` by
``StructType.fromJson``, so it can also live in a config file. The others are fields.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT_LIST = {"type": "array", "elementType": "string", "containsNull": True}

# Field names of the feeds and of the model answer.
METADATA_JSON = {
    "type": "struct",
    "fields": [
        {"name": "also_buy", "type": TEXT_LIST, "nullable": True, "metadata": {}},
        {"name": "also_view", "type": TEXT_LIST, "nullable": True, "metadata": {}},
        {"name": "asin", "type": "string", "nullable": True, "metadata": {}},
        {"name": "brand", "type": "string", "nullable": True, "metadata": {}},
        {"name": "category", "type": TEXT_LIST, "nullable": True, "metadata": {}},
        {"name": "date", "type": "string", "nullable": True, "metadata": {}},
        {"name": "description", "type": TEXT_LIST, "nullable": True, "metadata": {}},
        {"name": "details", "type": "string", "nullable": True, "metadata": {}},
        {"name": "feature", "type": TEXT_LIST, "nullable": True, "metadata": {}},
        {"name": "fit", "type": "string", "nullable": True, "metadata": {}},
        {"name": "image", "type": TEXT_LIST, "nullable": True, "metadata": {}},
        {"name": "main_cat", "type": "string", "nullable": True, "metadata": {}},
        {"name": "price", "type": "string", "nullable": True, "metadata": {}},
        {"name": "rank", "type": "string", "nullable": True, "metadata": {}},
        {"name": "similar_item", "type": "string", "nullable": True, "metadata": {}},
        {"name": "tech1", "type": "string", "nullable": True, "metadata": {}},
        {"name": "tech2", "type": "string", "nullable": True, "metadata": {}},
        {"name": "title", "type": "string", "nullable": True, "metadata": {}},
    ],
}
METADATA = StructType.fromJson(METADATA_JSON)

EVENT_BODY = StructType(
    [
        StructField("asin", StringType()),
        StructField("image", StringType()),
        StructField("overall", StringType()),
        StructField("reviewText", StringType()),
        StructField("reviewerID", StringType()),
        StructField("reviewerName", StringType()),
        StructField("style", StringType()),
        StructField("summary", StringType()),
        StructField("unix_review_time", StringType()),
        StructField("verified", StringType()),
        StructField("vote", StringType()),
        StructField("file_source", StringType()),
    ]
)

ANSWER = StructType(
    [
        StructField("sentiment", StringType()),
        StructField("actionable", StringType()),
        StructField("keywords", StringType()),
        StructField("response", StringType()),
    ]
)

RAW_REVIEWS = StructType(
    [
        StructField("asin", StringType()),
        StructField("image", StringType()),
        StructField("overall", DoubleType()),
        StructField("reviewText", StringType()),
        StructField("reviewerID", StringType()),
        StructField("reviewerName", StringType()),
        StructField("style", StringType()),
        StructField("summary", StringType()),
        StructField("unixReviewTime", LongType()),
        StructField("verified", BooleanType()),
        StructField("vote", StringType()),
    ]
)

EVENT_ENVELOPE = StructType(
    [
        StructField("body", BinaryType()),
        StructField("offset", StringType()),
        StructField("sequenceNumber", LongType()),
        StructField("enqueuedTime", TimestampType()),
    ]
)

POSITIONS = StructType(
    [
        StructField("event_source", StringType()),
        StructField("enqueued_time", StringType()),
        StructField("last_modification", StringType()),
        StructField("max_offset", LongType()),
        StructField("sequence_number", LongType()),
    ]
)

# One declared schema for batch and streamed reviews, so that their union never guesses types.
REVIEWS = StructType(
    [
        StructField("asin", StringType()),
        StructField("image", ArrayType(StringType())),
        StructField("overall", DoubleType()),
        StructField("review_text", StringType()),
        StructField("reviewer_id", StringType()),
        StructField("reviewer_name", StringType()),
        StructField("summary", StringType()),
        StructField("verified", BooleanType()),
        StructField("vote", StringType()),
        StructField("date", DateType()),
    ]
)

# Columns taken from metadata, and the order of the gold table.
GOLD_METADATA_COLUMNS = [
    "asin", "also_buy", "brand", "first_category", "description", "image", "main_cat", "price",
    "higher_rank", "title",
]
GOLD_COLUMNS = [
    "asin", "image", "overall", "review_text", "reviewer_id", "reviewer_name", "summary", "verified",
    "vote", "date", "also_buy", "brand", "first_category", "description", "image_met", "main_cat",
    "price", "higher_rank", "title", "brand_deviation_text", "reviewer_deviation_text", "year_month",
]
