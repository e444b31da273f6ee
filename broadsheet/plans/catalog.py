"""All registered queries and the SQL that checks them."""

from __future__ import annotations

from . import digest_queries, story_queries, stream_queries, text_queries, topic_queries

_MODULES = (text_queries, story_queries, digest_queries, topic_queries, stream_queries)

QUERIES = {name: fn for module in _MODULES for name, fn in module.Q.items()}
ORACLES = {name: text for module in _MODULES for name, text in module.S.items()}
