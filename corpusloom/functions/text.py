"""Text expressions. All of them are built-in Spark functions on Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------
# The characters Python counts as white space, as a trim set and as a Java regex class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
# White space that follows an end mark separates two sentences.
SENTENCE_BREAK = r"(?<=[.!?])" + WHITESPACE_RUN
# Characters no file name may hold.
FILE_NAME_FORBIDDEN = r'[\\/*?:"<>|]'
# Sections left out together with everything below them.
IGNORED_SECTIONS = (
    "see also",
    "references",
    "further reading",
    "external links",
    "notes",
    "citations",
    "bibliography",
)
# Error texts of a hit that has no page, of one whose lookup failed, and of a listed article without page.
MISSING_PAGE_ERROR = "Page '%s' does not exist according to wikipediaapi."
RETRIEVAL_ERROR = "Error retrieving page for '%s': %s"
UNFETCHED_ERROR = "Page '%s' does not exist or could not be fetched."
# ------------------------------------------------------------------------------------------------


def strip(text: Column) -> Column:
    """White space off both ends (Spark's own ``trim`` takes spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def split_sentences(text: Column) -> Column:
    """Sentences as an array, without empty ones."""
    return F.filter(F.split(strip(text), SENTENCE_BREAK), lambda s: s != "")


def split_words(text: Column) -> Column:
    """Words between white space; an empty array for blank text."""
    bare = strip(text)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, WHITESPACE_RUN)
    )


def clean_file_name(name: Column) -> Column:
    return F.regexp_replace(name, FILE_NAME_FORBIDDEN, "")


def topic_file_stem(topic: Column) -> Column:
    """Topic as part of a file name."""
    return F.replace(topic, F.lit(" "), F.lit("_"))


def topic_folder(topic: Column) -> Column:
    """Topic as a folder name."""
    return F.replace(topic, F.lit(" "), F.lit(""))


def url_title(title: Column) -> Column:
    return F.replace(title, F.lit(" "), F.lit("_"))


def comparable(title: Column) -> Column:
    """Form in which section titles are compared."""
    return F.lower(strip(title))


def is_ignored_section(title: Column, ignore: tuple[str, ...] = IGNORED_SECTIONS) -> Column:
    return F.coalesce(comparable(title).isin(*ignore), F.lit(False))


def missing_page_error(title: Column) -> Column:
    return F.format_string(MISSING_PAGE_ERROR, title)


def retrieval_error(title: Column, error: Column) -> Column:
    """Null where there was no error."""
    return F.when(error.isNotNull(), F.format_string(RETRIEVAL_ERROR, title, error))


def unfetched_error(title: Column) -> Column:
    return F.format_string(UNFETCHED_ERROR, title)


def trailing_number(name: Column) -> Column:
    """The number at the end of a name, all of its digits; null where there is none."""
    digits = F.regexp_extract(name, r"(\d+)$", 1)
    return F.when(digits != "", digits).try_cast("bigint")


def shard_of_name(name: Column) -> Column:
    """Zero-based shard of a registry name whose numbering starts at one."""
    return trailing_number(name) - 1


def error_text(error: Exception) -> str:
    """What a user's hook raised, for the row it raised it on."""
    return f"{type(error).__name__}: {error}"
