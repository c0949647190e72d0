"""Declared schemas; nothing is inferred, so partitions cannot disagree."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_BUSINESS = (
    T.StructType()
    .add("business_id", "string")
    .add("name", "string")
    .add("address", "string")
    .add("city", "string")
    .add("state", "string")
    .add("stars", "double")
    .add("review_count", "long")
    .add("categories", "string")
    .add("attributes", T.MapType(T.StringType(), T.StringType()))
    .add("hours", T.MapType(T.StringType(), T.StringType()))
)
RAW_USER = (
    T.StructType()
    .add("user_id", "string")
    .add("name", "string")
    .add("review_count", "long")
    .add("useful", "long")
    .add("average_stars", "double")
    .add("yelping_since", "string")
    .add("elite", "string")
    .add("friends", "string")
)
RAW_REVIEW = (
    T.StructType()
    .add("review_id", "string")
    .add("user_id", "string")
    .add("business_id", "string")
    .add("stars", "double")
    .add("useful", "long")
    .add("text", "string")
    .add("date", "string")
)
RAW_TIP = (
    T.StructType()
    .add("user_id", "string")
    .add("business_id", "string")
    .add("text", "string")
    .add("date", "string")
    .add("compliment_count", "long")
)
RAW_CHECKIN = T.StructType().add("business_id", "string").add("date", "string")

RAW = {
    "business": RAW_BUSINESS,
    "user": RAW_USER,
    "review": RAW_REVIEW,
    "tip": RAW_TIP,
    "checkin": RAW_CHECKIN,
}

# Key column of each document table; tips have none.
KEYS = {"businesses": "business_id", "users": "user_id", "reviews": "review_id"}

# Expected fields of the loaded tables: kinds a field may have.  Fixed values.
NUMBER = ("int", "bigint", "double", "float")
WHOLE = ("int", "bigint")
LIST = ("array<string>",)
TEXT = ("string",)
FLAG = ("boolean",)
STAMP = ("timestamp_ntz", "timestamp")

EXPECTED_TABLES = {
    "businesses": {
        "business_id": TEXT,
        "name": TEXT,
        "city": TEXT,
        "stars": NUMBER,
        "review_count": WHOLE,
        "checkin_count": WHOLE,
        "top_days": LIST,
        "top_hours": LIST,
        "categories": LIST,
    },
    "users": {
        "user_id": TEXT,
        "name": TEXT,
        "yelping_since": STAMP,
        "is_elite_ever": FLAG,
        "elite_year_count": WHOLE,
        "friends": LIST,
    },
    "reviews": {
        "review_id": TEXT,
        "user_id": TEXT,
        "business_id": TEXT,
        "stars": NUMBER,
        "date": STAMP,
        "text": TEXT,
    },
    "tips": {"user_id": TEXT, "business_id": TEXT, "text": TEXT, "date": STAMP},
}
EXPECTED_VERTICES = {
    "Business": {"business_id": TEXT, "name": TEXT, "stars": NUMBER, "review_count": WHOLE},
    "User": {"user_id": TEXT, "name": TEXT, "review_count": WHOLE, "average_stars": NUMBER},
    "Category": {"name": TEXT},
    "City": {"name": TEXT},
    "State": {"code": TEXT},
}
EXPECTED_EDGES = {
    "REVIEWED": {"stars": NUMBER, "date": STAMP},
    "TIP_LEFT": {"date": STAMP},
}
