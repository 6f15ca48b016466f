"""The six tables: declared schemas and logical keys (S2, section 1 of the survey)."""

from __future__ import annotations

# Column names and types of the input tables, in file order.
SCHEMAS = {
    "business": (
        "business_id string, name string, address string, city string, state string, postal_code string, "
        "latitude double, longitude double, stars double, review_count int, is_open int, "
        "attributes map<string,string>, categories string, hours map<string,string>"
    ),
    "review": (
        "review_id string, user_id string, business_id string, stars double, date string, text string, "
        "useful int, funny int, cool int"
    ),
    "user": (
        "user_id string, name string, review_count int, yelping_since string, friends string, "
        "useful int, funny int, cool int, fans int, elite string, average_stars double, "
        "compliment_hot int, compliment_more int, compliment_profile int, compliment_cute int, "
        "compliment_list int, compliment_note int, compliment_plain int, compliment_cool int, "
        "compliment_funny int, compliment_writer int, compliment_photos int"
    ),
    "checkin": "business_id string, date string",
    "tip": "text string, date string, compliment_count int, business_id string, user_id string",
    "photo": "photo_id string, business_id string, caption string, label string",
}

# The columns that identify a row.
KEYS = {
    "business": ["business_id"],
    "review": ["review_id"],
    "user": ["user_id"],
    "checkin": ["business_id", "date"],
    "tip": ["user_id", "business_id", "date"],
    "photo": ["photo_id"],
}

# Identifiers, never screened out and never scaled.
IDENTIFIERS = ["business_id", "user_id", "review_id", "photo_id"]

# The compliment counters of a user.
COMPLIMENTS = [
    "compliment_hot",
    "compliment_more",
    "compliment_profile",
    "compliment_cute",
    "compliment_list",
    "compliment_note",
    "compliment_plain",
    "compliment_cool",
    "compliment_funny",
    "compliment_writer",
    "compliment_photos",
]
