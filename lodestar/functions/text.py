"""Document text and tokenizer profiles as Column expressions.

Every profile is a ``regexp_replace`` + ``split`` pipeline, so tokenising stays inside
whole-stage codegen on the JVM; no Python runs per row.  A profile turns a lower-cased
document string into an array of *raw pieces* (empty pieces included).  Raw pieces keep
the 1-based piece index that the positional index uses; counting indexes drop empties.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# These must equal the reference's patterns and stop list exactly, since
# every count, position and weight depends on them.
#
#   T1        (\pP)|(\pS)|(\d)|(\s)|(null)|(amp)|(quot)          -> " "
#   T1b       (\pP)|(\pS)|(\d+)|(\s)|(null)|(amp)|(quot)         -> " "
#   T2-legacy T1 alternatives followed by the stop words as bare alternatives, in this
#             order: a the of an that at in without within between this these those
#             their his her its my                                 -> " "
#   T3        (\pP)|(\pS)|(\s)|(null)|(amp)|(quot)               -> " ", then tokens
#             containing a digit are dropped (their position still counts)
#   T4-legacy delete (\pS)|(\d+), then (\pP)|(\s)|(null)|(amp)|(quot) -> " "
# ---------------------------------------------------------------------------------------
T1_PATTERN = r"(\pP)|(\pS)|(\d)|(\s)|(null)|(amp)|(quot)"
T1B_PATTERN = r"(\pP)|(\pS)|(\d+)|(\s)|(null)|(amp)|(quot)"
STOP_WORDS = (
    "a", "the", "of", "an", "that", "at", "in", "without", "within", "between",
    "this", "these", "those", "their", "his", "her", "its", "my",
)
T2_LEGACY_PATTERN = T1_PATTERN + "|" + "|".join(f"({w})" for w in STOP_WORDS)
T3_PATTERN = r"(\pP)|(\pS)|(\s)|(null)|(amp)|(quot)"
T4_DELETE_PATTERN = r"(\pS)|(\d+)"
T4_SPACE_PATTERN = r"(\pP)|(\s)|(null)|(amp)|(quot)"
DIGIT_PATTERN = r"\d"

# After a profile's replacement the only whitespace left is single spaces, so a token is a
# maximal run of non-space characters.  Whole tokens are dropped by blanking them in place
# (replacement ""), which leaves an empty piece and so keeps every later position intact.
STOP_TOKEN_PATTERN = "(?<=^| )(" + "|".join(STOP_WORDS) + ")(?= |$)"
DIGIT_TOKEN_PATTERN = r"[^ ]*\d[^ ]*"
PAIR_PATTERN = r"(?:^| )(?=([^ ]+ [^ ]+))"


@dataclass(frozen=True)
class Profile:
    """How a lower-cased text becomes raw pieces; non-empty pieces are the tokens.

    Only ``regexp_replace``, ``split`` and ``array_remove`` are used - all of them take
    part in whole-stage codegen (a lambda such as ``filter(x -> ...)`` would not).
    """

    name: str
    replace: tuple[tuple[str, str], ...]

    def normalized(self, text: Column) -> Column:
        """The text after the profile's replacements: tokens separated by spaces."""
        out = text
        for pattern, repl in self.replace:
            out = F.regexp_replace(out, pattern, repl)
        return out

    def pieces(self, text: Column) -> Column:
        """Raw split pieces, empties included (piece i sits at 1-based position i)."""
        return F.split(self.normalized(text), " ", -1)

    def pairs(self, text: Column) -> Column:
        """Array of "w1 w2" strings for consecutive tokens; empty when fewer than two.

        Runs of spaces collapse to one, then every token start proposes itself and its
        successor through a capturing lookahead - one regex pass, inside codegen, instead
        of an array lambda (which would fall back to interpreted evaluation).
        """
        single = F.trim(F.regexp_replace(self.normalized(text), " +", " "))
        return F.regexp_extract_all(single, F.lit(PAIR_PATTERN), 1)

    @staticmethod
    def keep(tok: Column) -> Column:
        """Predicate on one piece: does it count as a token?"""
        return tok != F.lit("")

    def terms(self, text: Column) -> Column:
        """Array of tokens in order (empty pieces removed)."""
        return F.array_remove(self.pieces(text), "")


PROFILES: dict[str, Profile] = {
    "t1": Profile("t1", ((T1_PATTERN, " "),)),
    "t1b": Profile("t1b", ((T1B_PATTERN, " "),)),
    "t2": Profile("t2", ((T1_PATTERN, " "), (STOP_TOKEN_PATTERN, ""))),
    "t2_legacy": Profile("t2_legacy", ((T2_LEGACY_PATTERN, " "),)),
    "t3": Profile("t3", ((T3_PATTERN, " "), (DIGIT_TOKEN_PATTERN, ""))),
    "t4_legacy": Profile("t4_legacy", ((T4_DELETE_PATTERN, ""), (T4_SPACE_PATTERN, " "))),
}


def profile(name: str) -> Profile:
    try:
        return PROFILES[name]
    except KeyError:
        raise ValueError(f"unknown tokenizer profile {name!r}; have {sorted(PROFILES)}") from None


def doc_text(title: Column | str = "title", byline: Column | str = "byline",
             text: Column | str = "text") -> Column:
    """Indexed text of a document: lower(title + ' ' + byline + ' ' + text).

    Missing parts are skipped (``concat_ws``); the headline is never indexed.
    """
    return F.lower(F.concat_ws(" ", _col(title), _col(byline), _col(text)))


def tokens(corpus: DataFrame, profile_name: str = "t1", id_col: str = "doc_id") -> DataFrame:
    """Long-form tokens ``(doc_id, pos, token)``; ``pos`` is the 1-based raw piece index.

    One row per kept token.  ``posexplode`` keeps the work per input row, so this is a
    narrow transformation: no shuffle, partitions follow the corpus scan.  The ``_outer``
    form avoids Catalyst's inferred ``size(...) > 0`` pre-filter, which would run the
    tokenizer regex twice; its null row for an empty array fails ``keep``.
    """
    prof = profile(profile_name)
    pieces = corpus.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode_outer(prof.pieces(doc_text())).alias("pos0", "token"),
    )
    return pieces.where(prof.keep(F.col("token"))).select(
        "doc_id", (F.col("pos0") + 1).cast("bigint").alias("pos"), "token"
    )


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
