"""Markup clean-up and display formatting (Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Clean-up rules for news markup (must match for equal texts).  CR-LF
# pairs are removed; paragraph tags, the two entities and bare newlines become a space.
CRLF_PATTERN = "\r\n"
MARKUP_PATTERN = r"(<p>)|(</p>)|(&quot;)|(&amp;)|(\n)"
# Display rules for headlines: commas are dropped, "&amp;" is shown as "&".
AMP_ENTITY = "&amp;"


def clean_markup(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, CRLF_PATTERN, ""), MARKUP_PATTERN, " ")


def clean_headline(headline: Column) -> Column:
    return F.replace(F.replace(F.coalesce(headline, F.lit("")), F.lit(","), F.lit("")),
                     F.lit(AMP_ENTITY), F.lit("&"))


def format_hit(doc_id: Column, headline: Column, sep: str = ":") -> Column:
    """'id:headline' (BM25 result style) or 'id,headline' (tf-idf result style)."""
    return F.concat(doc_id.cast("string"), F.lit(sep), F.coalesce(headline, F.lit("")))
