"""Text functions: markup removal, name normalization, comparison keys."""

from __future__ import annotations

import html
import io
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

SPACE = r"(?U)\s+"
# Every character that counts as white space.
SPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Limits of markup removal that decide the resulting text.
ENTITY_ROUNDS = 5
TAG_PATTERN = r"</?[A-Za-z][^>]*>"

# Entities whose characters are decoded without a table, and what must be
# left to a reader of markup: other entities, elements with content of their own kind,
# white space that only some readers know.
SIMPLE_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&nbsp;": "\xa0", "&amp;": "&"}
OTHER_ENTITY = r"&(?:[A-Za-z]|#)"
WELL_FORMED_TAG = r"""</?[A-Za-z][A-Za-z0-9]*+(?:\s++[A-Za-z_:][\w:.-]*+(?:\s*+=\s*+(?:"[^"<>]*+"|'[^'<>]*+'|[^\s"'<>=`]++))?+)*+\s*+/?>"""
RAW_ELEMENTS = r"(?i)</?(?:script|style|textarea|title|xmp|iframe|noembed|noframes|noscript|plaintext)"
OPEN_MARKUP = r"<(?:[A-Za-z/!?]|\z)"
ODD_SPACE = "[\x1c-\x1f]"

# Texts that stand for "no value" in attribute tables.
PLACEHOLDERS = (
    "",
    "missing",
    "not collected",
    "not provided",
    "not applicable",
    "not available",
    "unknown",
    "n/a",
    "na",
    "null",
    "none provided",
)


def strip(value: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(value, F.lit(SPACE_CHARACTERS))


def squeeze(value: Column) -> Column:
    """Collapse white space to single spaces and trim; the comparison form of a text."""
    return F.trim(F.regexp_replace(value, SPACE, " "))


def fold_case(value: Column) -> Column:
    """Case-insensitive form: lower case, with the sharp s and final sigma unified."""
    return F.replace(F.replace(F.lower(value), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def normalized_name(name: Column) -> Column:
    """Attribute name with separators turned into spaces, for alias lookup."""
    return squeeze(fold_case(F.regexp_replace(name, r"[_/\-]+", " ")))


def tissue_key(value: Column) -> Column:
    """Comparison form that ignores one leading ``[label]`` and case."""
    return fold_case(F.regexp_replace(squeeze(value), r"^\[[^\]]+\]\s*", ""))


def is_placeholder(value: Column) -> Column:
    """Whether a (markup-free) text stands for a missing value."""
    return fold_case(squeeze(value)).isin(*PLACEHOLDERS)


def safe_identifier(value: Column) -> Column:
    """Identifier usable as a file name, or null when nothing usable remains."""
    cleaned = F.regexp_replace(strip(value), r"[^A-Za-z0-9._-]+", "_")
    return F.when(~cleaned.isin("", ".", ".."), cleaned)


def is_safe_accession(value: Column) -> Column:
    """Whether a text may be put into an archive query."""
    return value.rlike(r"^[A-Za-z0-9][A-Za-z0-9_.:-]*$")


def is_numeric_id(value: Column) -> Column:
    """Whether a text is an archive-internal number instead of an accession."""
    return value.rlike(r"^[0-9]+$")


def last_error_line(error: Column) -> Column:
    """The last line of an error text that is not blank, trimmed."""
    lines = F.transform(F.split(error, r"\r\n|\r|\n"), strip)
    return F.try_element_at(F.filter(lines, lambda line: line != ""), F.lit(-1))


def bounded_error(error: Column, characters: int = 20_000) -> Column:
    """The end of an error text, where the cause of a failure stands."""
    return F.right(error, F.lit(characters))


class _Reader(HTMLParser):
    """Writes the character data of one document after the other into a buffer."""

    def shown(self, document: str) -> str:
        self.reset()
        self.buffer = io.StringIO()
        self.feed(document)
        self.close()
        return " ".join(self.buffer.getvalue().split())

    def handle_data(self, data: str) -> None:
        self.buffer.write(data)


def plain_texts(values: pd.Series) -> pd.Series:
    """Texts of a batch without entities and, where something looks like a tag, tags.

    Entities are decoded round by round, each round only where an ampersand is left; only
    texts with a tag then go through the HTML reader. Nulls stay.
    """
    texts = values.copy()
    for _ in range(ENTITY_ROUNDS):
        encoded = texts.str.contains("&", regex=False, na=False)
        if not encoded.any():
            break
        texts[encoded] = texts[encoded].map(html.unescape)
    tagged = texts.str.contains(TAG_PATTERN, na=False)
    if tagged.any():
        texts[tagged] = texts[tagged].map(_Reader(convert_charrefs=True).shown)
    return texts


@F.arrow_udf(StringType())
def _finished_texts(plain: pa.Array, left: pa.Array) -> pa.Array:
    """The plain texts, where there is none that of the text left to the reader."""
    if left.null_count == len(left):
        return plain
    unread = left.is_valid()
    read = plain_texts(left.filter(unread).to_pandas())
    return pc.replace_with_mask(plain, unread, pa.array(read, plain.type))


def _simply_decoded(value: Column) -> Column:
    """Text after rounds of decoding the entities that need no table.

    The ampersand's own entity is decoded last in a round, so one round never decodes
    what it has just made, as with a decoder that reads from left to right. Rounds without
    an ampersand or a semicolon have nothing to decode.
    """
    def decoded(text: Column, _round: Column) -> Column:
        result = text
        for entity, character in SIMPLE_ENTITIES.items():
            result = F.replace(result, F.lit(entity), F.lit(character))
        return F.when(F.contains(text, F.lit("&")) & F.contains(text, F.lit(";")), result).otherwise(text)

    return F.reduce(F.array(*map(F.lit, range(ENTITY_ROUNDS))), value, decoded)


def plain_in_jvm(value: Column, *, angles: bool = False) -> Column:
    """Text without markup where built-in functions can tell it, else null.

    That is where only entities of ``SIMPLE_ENTITIES`` occur and each ``<`` of a text with
    tags begins a well-formed tag of an element whose content is text like any other. With
    ``angles`` a ``<`` may also be text itself, where what follows it begins no markup.
    """
    def plain(decoded: Column) -> Column:
        untagged = F.regexp_replace(decoded, WELL_FORMED_TAG, "")
        left = untagged.rlike(OPEN_MARKUP) if angles else F.contains(untagged, F.lit("<"))
        odd = left | decoded.rlike(RAW_ELEMENTS) | decoded.rlike(ODD_SPACE)
        return (
            F.when(decoded.rlike(OTHER_ENTITY), F.lit(None).cast("string"))
            .when(~decoded.rlike(TAG_PATTERN), decoded)
            .when(~odd, squeeze(untagged))
        )

    # A lambda names the decoded text, so it is made once.
    marked = F.transform(F.array(_simply_decoded(value)), plain)[0]
    return F.when(~value.rlike("[<&]"), value).otherwise(marked)


def without_markup(value: Column) -> Column:
    """Text without presentation markup.

    What ``plain_in_jvm`` cannot tell is read by an Arrow-batched function, which knows all
    named entities and reads any markup; all other texts pass through it as they are, so
    that they are made plain once.
    """
    plain = plain_in_jvm(value, angles=True)
    return _finished_texts(plain, F.when(plain.isNull(), value))


@F.arrow_udf(ArrayType(StringType()))
def _read_lists(left: pa.Array) -> pa.Array:
    """Lists of plain texts for the lists left to the reader."""
    if left.null_count == len(left):
        return left
    read = pa.array(plain_texts(left.flatten().to_pandas()), pa.string())
    lists = pa.ListArray.from_arrays(pa.array(_offsets(left), pa.int32()), read)
    return pc.if_else(left.is_valid(), lists, pa.scalar(None, lists.type))


def _offsets(lists: pa.Array) -> list[int]:
    ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(lists), 0))
    return [0, *ends.to_pylist()]


def with_plain_lists(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with these lists of texts without markup, as ``without_markup`` makes them.

    Only a list with a text that ``plain_in_jvm`` cannot tell goes to the reader.
    """
    plain = {n: F.transform(n, lambda v: plain_in_jvm(v, angles=True)) for n in names}
    told = df.withColumns({f"_told {n}": column for n, column in plain.items()})

    def finished(n: str) -> Column:
        done = F.col(f"_told {n}")
        return F.coalesce(_read_lists(F.when(F.exists(done, lambda v: v.isNull()), F.col(n))), done)

    return told.withColumns({n: finished(n) for n in names}).drop(*[f"_told {n}" for n in names])
