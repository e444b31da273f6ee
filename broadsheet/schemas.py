"""Column layouts and fixed values shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Category names in their fixed order.
TAXONOMY = ("AI", "Economy", "Stocks", "Private Equity", "Politics", "Technology", "Other")
CATCH_ALL = "Other"
# Enum members of the scoring schemas.
CONFIDENCES = ("high", "medium", "low")
GROUP_TYPES = ("duplicate", "similar", "unique")

# Keywords tried per category, in order of precedence.
KEYWORD_RULES = (
    ("AI", ("ai", "artificial intelligence", "machine learning", "llm", "chatbot")),
    ("Economy", ("economy", "economic", "gdp", "inflation", "market", "financial")),
    ("Stocks", ("stock", "shares", "trading", "equity", "nasdaq", "sp500", "dow")),
    ("Private Equity", ("private equity", "pe", "buyout", "acquisition")),
    ("Politics", ("politics", "political", "government", "election", "policy", "congress")),
    ("Technology", ("technology", "tech", "software", "hardware", "startup")),
)

# Texts that appear in results.
DEFAULT_TITLE = "Daily News Digest - "
RULE_SECTION = "Top Stories"
RULE_INTRO = "Latest developments in "
FALLBACK_TOPIC = "General"
FALLBACK_POINT = "Content from email body"
UNTITLED_CATEGORY = "Untitled Category"
UNTITLED_SUBCATEGORY = "Highlights"
EMPTY_SUBCATEGORY = "No news items available for this subcategory."
EMPTY_DIGEST_TITLE = "No News Items"
EMPTY_DIGEST_TEXT = "We could not find any stories to share today."
SUMMARY_TITLE = "Executive Summary"
UNKNOWN_SENDER = "Unknown sender"
NO_ACCOUNTS = "Authentication failed"
NO_NEWS = "No news content found"
NO_ITEMS = "No extractable news content"

HEADER = T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())])

MESSAGE_EXPORT = T.StructType([
    T.StructField("account", T.StringType()),
    T.StructField("message_id", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("headers", T.ArrayType(HEADER)),
    T.StructField("parts", T.ArrayType(T.StructType([
        T.StructField("part_path", T.ArrayType(T.IntegerType())),
        T.StructField("mime", T.StringType()),
        T.StructField("data", T.StringType()),
    ]))),
])

# The field names below are the answer and file formats.
CLASSIFICATION = T.StructType([
    T.StructField("is_news", T.BooleanType()),
    T.StructField("confidence", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("primary_category", T.StringType()),
    T.StructField("secondary_categories", T.ArrayType(T.StringType())),
    T.StructField("topic_category", T.StringType()),
])

SOURCE = T.StructType([
    T.StructField("subject", T.StringType()),
    T.StructField("sender", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("account", T.StringType()),
])

# Consolidated stories as exported for preview; fields may be absent.
STORY_FILE = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("main_topic", T.StringType()),
        T.StructField("source_urls", T.ArrayType(T.StringType())),
        T.StructField("key_points", T.ArrayType(T.StringType())),
        T.StructField("all_sources", T.ArrayType(SOURCE)),
        T.StructField("source_accounts", T.ArrayType(T.StringType())),
        T.StructField("group_type", T.StringType()),
        T.StructField("original_count", T.LongType()),
    ]))),
])

# One proposed digest layout, nested as a scoring provider returns it.
LAYOUT = T.StructType([
    T.StructField("newsletter_title", T.StringType()),
    T.StructField("executive_summary", T.StringType()),
    T.StructField("categories", T.ArrayType(T.StructType([
        T.StructField("category_name", T.StringType()),
        T.StructField("subcategories", T.ArrayType(T.StructType([
            T.StructField("subcategory_name", T.StringType()),
            T.StructField("item_ids", T.ArrayType(T.LongType())),
            T.StructField("intro_text", T.StringType()),
        ]))),
    ]))),
])
