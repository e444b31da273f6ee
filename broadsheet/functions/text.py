"""Text normalisation as Column -> Column functions; no Python workers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import DEFAULT_TITLE

# The classifier's input bound and its mark.
TRUNCATE_LIMIT = 8000
TRUNCATE_MARK = "\n\n[TRUNCATED]"

# Tags and link attributes that survive the tag policy.
ALLOWED_TAGS = (
    "p", "br", "strong", "em", "b", "i", "a", "ul", "ol", "li", "span", "div",
    "h1", "h2", "h3", "h4", "blockquote", "code", "pre",
)
ALLOWED_LINK_ATTRIBUTES = ("href", "title", "target", "rel")
SAFE_ADDRESS = r"(?i)^\s*(?:https?://|mailto:)"

# Date placeholders, replaced one after the other in this order.
DATE_PLACEHOLDERS = ("[Date]", "[date]", "{Date}", "{date}", "{{Date}}", "{{date}}", "<<Date>>")

# Header defaults.
HEADER_DEFAULTS = {"Subject": "No Subject", "From": "Unknown Sender", "Date": "Unknown Date"}

LONG_DATE = "EEEE, MMMM dd, yyyy"
SHORT_DATE = "MMMM dd, yyyy"


def header(headers: Column, name: str, default: str | None = None) -> Column:
    """Value of the last header called exactly ``name``; default only if absent."""
    matches = F.filter(headers, lambda h: h["name"] == name)
    value = F.try_element_at(matches, F.lit(-1))["value"]
    fallback = HEADER_DEFAULTS.get(name) if default is None else default
    return F.when(F.coalesce(F.size(matches), F.lit(0)) > 0, value).otherwise(F.lit(fallback))


BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def decode_b64url(data: Column) -> Column:
    """base64url -> UTF-8 text; bad bytes become U+FFFD, bad base64 becomes ''.

    Characters outside the alphabet are skipped, as mail decoders do.
    """
    standard = F.replace(F.replace(data, F.lit("-"), F.lit("+")), F.lit("_"), F.lit("/"))
    # A regular expression costs many times the decoding, so only data that has other characters pays it.
    known = F.when(F.translate(standard, BASE64, "") == "", standard).otherwise(F.regexp_replace(standard, "[^A-Za-z0-9+/]+", ""))
    raw = F.try_to_binary(known, F.lit("base64"))
    return F.coalesce(F.make_valid_utf8(raw.cast("string")), F.lit(""))


def strip(c: Column) -> Column:
    """Remove leading and trailing white space, Unicode spaces included."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def html_to_text(html: Column, drop_script_style: bool = False) -> Column:
    """Block-level tags open a line, other tags vanish, blank runs shrink to one."""
    if drop_script_style:
        html = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", "")
    # The three patterns, applied in this order.
    lines = F.regexp_replace(html, r"(?iU)<\s*(br|p|div|li|tr|td)\b[^>]*>", "\n")
    bare = F.regexp_replace(lines, r"<[^>]+>", "")
    return F.coalesce(strip(F.regexp_replace(bare, r"\n\n+", "\n\n")), F.lit(""))


def truncate(c: Column, limit: int = TRUNCATE_LIMIT) -> Column:
    """The classifier's input bound: cut with a visible mark beyond ``limit``."""
    cut = F.concat(F.substring(c, 1, limit), F.lit(TRUNCATE_MARK))
    return F.coalesce(F.when(F.length(c) > limit, cut).otherwise(c), F.lit(""))


def escape_html(c: Column) -> Column:
    # The five escapes, ampersand first.
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def escape_text(c: Column) -> Column:
    """Text between tags: stray brackets and ampersands are escaped, entities stay."""
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return F.regexp_replace(c, r"&amp;(#?[A-Za-z0-9]+;)", "&$1")


_ATTRIBUTES = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
#: What markup consists of: an element whose content is raw text, a comment, a tag, whose quoted values may hold any bracket, or text.
MARKUP = (
    rf"(?is)<(?:script|style)\b{_ATTRIBUTES}>.*?</(?:script|style)\s*>|<!--.*?-->|<{_ATTRIBUTES}>|[^<]++|<"
)
_RAW_OPEN, _RAW_CLOSE = rf"(?is)^<(?:script|style)\b{_ATTRIBUTES}>", r"(?is)</(?:script|style)\s*>$"
ATTRIBUTE = r"""[\s/][A-Za-z][-A-Za-z0-9_:]*\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>]+)"""


def apply_tag_policy(html: Column) -> Column:
    """Drop tags outside the allowlist but keep their text.

    The markup is split into text, tags, comments and raw elements, each state with its own end, so that a bracket inside a
    quoted value, a comment or a script ends nothing. Comments go; text is escaped, that of
    scripts and an unclosed tag included. An allowed tag is rebuilt from its name; links keep the allowed
    attributes, quoted either way or not at all, and an address only if it starts
    with a safe scheme as it stands, so that no encoded scheme gets through.
    """
    tokens = F.regexp_extract_all(html, F.lit(MARKUP), F.lit(0))

    def attribute(found: Column) -> Column:
        name = F.lower(F.regexp_extract(found, r"^[\s/]([-A-Za-z0-9_:]+)", 1))
        value = F.regexp_replace(F.regexp_replace(found, r"^[\s/][-A-Za-z0-9_:]+\s*=\s*", ""), r"""^["']|["']$""", "")
        safe = name.isin(*ALLOWED_LINK_ATTRIBUTES) & ((name != "href") | value.rlike(SAFE_ADDRESS))
        return F.when(safe, F.concat(F.lit(" "), name, F.lit('="'), F.replace(escape_text(value), F.lit('"'), F.lit("&quot;")), F.lit('"'))).otherwise("")

    def tag(token: Column) -> Column:
        slash = F.regexp_extract(token, r"^<\s*(/?)", 1)
        name = F.lower(F.regexp_extract(token, r"^<\s*/?\s*([A-Za-z][A-Za-z0-9]*)", 1))
        link = F.when((name == "a") & (slash == ""), F.array_join(F.transform(F.regexp_extract_all(token, F.lit(ATTRIBUTE), F.lit(0)), attribute), ""))
        return F.when(name.isin(*ALLOWED_TAGS), F.concat(F.lit("<"), slash, name, F.coalesce(link, F.lit("")), F.lit(">"))).otherwise("")

    def rebuild(token: Column) -> Column:
        raw = F.regexp_replace(F.regexp_replace(token, _RAW_OPEN, ""), _RAW_CLOSE, "")
        return (
            F.when(~F.startswith(token, F.lit("<")) | (token == "<"), escape_text(token))
            .when(F.startswith(token, F.lit("<!--")), "")
            .when(token.rlike(r"(?i)^<(?:script|style)\b") & token.rlike(_RAW_CLOSE), escape_text(raw))
            .otherwise(tag(token))
        )

    return F.coalesce(F.array_join(F.transform(tokens, rebuild), ""), F.lit(""))


def tag_names(html: Column) -> Column:
    return F.transform(
        F.regexp_extract_all(html, F.lit(r"<\s*/?\s*([A-Za-z][A-Za-z0-9]*)"), F.lit(1)), F.lower
    )


def clean_url(url: Column) -> Column:
    return strip(url)


def display_url(url: Column) -> Column:
    shown = clean_url(url)
    for noise in ("https://", "http://", "www."):
        shown = F.replace(shown, F.lit(noise), F.lit(""))
    return shown


def is_safe_url(url: Column) -> Column:
    return clean_url(url).rlike(r"(?i)^https?://")


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(clean_url(url), r"(?i)^https?://([^/?#:]+)", 1))


def extract_urls(text: Column) -> Column:
    """Distinct link targets, quoted either way or not at all, and bare web addresses, in order of appearance."""
    targets = F.regexp_extract_all(text, F.lit(r"""(?i)\bhref\s*=\s*(?:"[^"]+"|'[^']+'|[^\s"'<>]+)"""), F.lit(0))
    named = F.transform(targets, lambda t: F.regexp_replace(F.regexp_replace(t, r"(?i)^href\s*=\s*", ""), r"""^["']|["']$""", ""))
    bare = F.regexp_extract_all(text, F.lit(r"""(?i)\bhttps?://[^\s"'<>()]+"""), F.lit(0))
    return F.array_distinct(F.concat(named, bare))


def sender_address(sender: Column) -> Column:
    """Address part of a From header, lower case; the whole header if it has no <...>."""
    inside = F.regexp_extract(sender, r"<([^<>]*)>", 1)
    return F.lower(F.trim(F.when(inside != "", inside).otherwise(sender)))


def fill_title(title: Column, as_of: Column) -> Column:
    """Default for a missing title, then the date placeholders in list order."""
    default = F.concat(F.lit(DEFAULT_TITLE), F.date_format(as_of, SHORT_DATE))
    filled = F.coalesce(F.nullif(title, F.lit("")), default)
    for placeholder in DATE_PLACEHOLDERS:
        filled = F.replace(filled, F.lit(placeholder), F.date_format(as_of, LONG_DATE))
    return filled


def digest_stamps(as_of: Column) -> list[Column]:
    return [
        F.date_format(as_of, LONG_DATE + " HH:mm:ss").alias("generated_at"),
        F.date_format(as_of, LONG_DATE).alias("display_date"),
        F.date_format(as_of, "HH:mm:ss").alias("generated_time"),
    ]


def word_runs(c: Column) -> Column:
    """Lower-cased words with one space before, between and after; phrases are found by ``contains``."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def normalised(c: Column) -> Column:
    """Lower case with runs of white space collapsed; the base of fingerprints."""
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def fingerprint(c: Column) -> Column:
    return F.sha2(normalised(c), 256)
