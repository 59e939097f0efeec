"""Column expressions that take fields out of one page's markup.

Tags are looked up without regard to the case of A-Z, in the page as it was read, so
that lower-casing can never shift an offset. Fields are lower-cased after extraction.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markup of a page in a wiki export.
ID_PATTERN = r"(?i)<id>(.*?)</id>"
TITLE_PATTERN = r"(?i)<title>(.*?)</title>"
USERNAME_PATTERN = r"(?i)<username>(.*?)</username>"
REDIRECT_PATTERN = r"(?i)<redirect title=\"([^\"]*)\""
TIMESTAMP_PATTERN = r"(?i)<timestamp>(.*?)</timestamp>"
BODY_PATTERN = r"(?i)<{tag}.*>([\s\S]*)</{tag}>"
CONTRIBUTOR_OPEN = "<contributor>"
CONTRIBUTOR_CLOSE = "</contributor>"


def plain_case(page: Column) -> Column:
    """A-Z as a-z; every character keeps its place."""
    return F.translate(page, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def first_group(text: Column, pattern: str) -> Column:
    """Group 1 of the first match, or the empty string."""
    return F.regexp_extract(text, pattern, 1)


def page_id(page: Column) -> Column:
    """The first ``<id>`` as BIGINT; null when missing or not a number."""
    return first_group(page, ID_PATTERN).try_cast("bigint")


def page_title(page: Column) -> Column:
    return first_group(page, TITLE_PATTERN)


def redirect_target(page: Column) -> Column:
    """The title that the page stands for, or the empty string."""
    return first_group(page, REDIRECT_PATTERN)


def page_timestamp(page: Column) -> Column:
    return first_group(page, TIMESTAMP_PATTERN)


def contributor_block(page: Column, plain: Column | None = None) -> Column:
    """Text between the contributor tags; null when either tag is missing.

    Here and below, ``plain`` is ``plain_case(page)`` where a caller has it as a column.
    """
    plain = plain_case(page) if plain is None else plain
    opened = F.locate(CONTRIBUTOR_OPEN, plain)
    closed = F.locate(CONTRIBUTOR_CLOSE, plain)
    start = opened + F.lit(len(CONTRIBUTOR_OPEN))
    inner = F.substring(page, start, F.greatest(closed - start, F.lit(0)))
    return F.when((opened > 0) & (closed > 0), inner)


def contributor(page: Column, plain: Column | None = None) -> Column:
    """Lower-case ``struct(name, id)``; empty strings for an anonymous edit, null without a block."""
    block = contributor_block(page, plain)
    fields = F.struct(
        F.lower(first_group(block, USERNAME_PATTERN)).alias("name"),
        F.lower(first_group(block, ID_PATTERN)).alias("id"),
    )
    return F.when(block.isNotNull(), fields)


def _locate_from(needle: str, text: Column, position: Column) -> Column:
    return F.call_function("locate", F.lit(needle), text, position)


def body_start(page: Column, tag: str = "text", plain: Column | None = None) -> Column:
    """1-based index of the first character after the opening tag, null if absent.

    The opening tag may span lines: the start is the first ``>`` after ``<tag``.
    """
    opened = F.locate(f"<{tag}", plain_case(page) if plain is None else plain)
    bracket = _locate_from(">", page, opened)
    return F.when((opened > 0) & (bracket > 0), bracket + F.lit(1))


def body_length(page: Column, tag: str = "text", plain: Column | None = None) -> Column:
    """Length in code points of the body, null when absent, empty or self-closing."""
    closed = F.locate(f"</{tag}>", plain_case(page) if plain is None else plain)
    size = closed - body_start(page, tag, plain)
    return F.when((closed > 0) & (size > 0), size)


def body_by_index(page: Column, tag: str = "text", plain: Column | None = None) -> Column:
    """Body between the first opening and the first closing tag; null if none."""
    return F.substring(page, body_start(page, tag, plain), body_length(page, tag, plain))


def body_by_regex(page: Column, tag: str = "text") -> Column:
    """Body by one pattern: the opening tag must sit on one line, the close is the last.

    Null when nothing matches or the body is empty.
    """
    return F.nullif(first_group(page, BODY_PATTERN.format(tag=tag)), F.lit(""))
