"""Column expressions over document text. Everything here runs inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD_PATTERN = r"[\p{L}\p{N}_]+"
# Unicode white space plus the four separator controls that also count as blank
BLANK = r"[\s\x1c-\x1f]"
NOT_BLANK = r"(?U)[^\s\x1c-\x1f]"
STRIP_PATTERN = rf"(?U)\A{BLANK}+|{BLANK}+\z"

LANGUAGE_KEYS = ("language", "lang")
SCORE_KEYS = ("language_score", "lang_score", "language_confidence")


def first_present(schema: T.StructType, keys: Sequence[str], default: object = None) -> Column:
    """First non-null value among top-level and ``metadata`` fields, key by key, as a string."""
    found = present_fields(schema, keys)
    values = [value.cast("string") for value in found]
    return F.coalesce(*values, F.lit(default).cast("string"))


def present_fields(schema: T.StructType, keys: Sequence[str]) -> list[Column]:
    names = set(schema.names)
    nested = schema["metadata"].dataType if "metadata" in names else None
    found = []
    for key in keys:
        if key in names:
            found.append(F.col(key))
        if isinstance(nested, T.MapType) or (isinstance(nested, T.StructType) and key in nested.names):
            found.append(F.col("metadata")[key])
    return found


def language_filter(df: DataFrame, language: str = "en", min_score: float = 0.9) -> DataFrame:
    """Keep rows in ``language`` with enough confidence; rows without such fields pass."""
    tags = present_fields(df.schema, LANGUAGE_KEYS)
    if len(tags) == 1:
        # kept in this form because it is pushed into the Parquet scan, unlike a coalesce
        df = df.filter((tags[0] == F.lit(language)) | tags[0].isNull())
    elif tags:
        df = df.filter(first_present(df.schema, LANGUAGE_KEYS, language) == F.lit(language))
    if present_fields(df.schema, SCORE_KEYS):
        score = first_present(df.schema, SCORE_KEYS, 1.0).try_cast("double")
        df = df.filter((score >= F.lit(min_score)) & ~F.isnan(score))
    elif min_score > 1.0:
        df = df.filter(F.lit(False))
    return df


def text_value(schema: T.StructType, text_field: str = "text") -> Column:
    """``text_field``, or ``text`` where that is null or empty, or an empty string."""
    options = [F.nullif(F.col(name), F.lit("")) for name in dict.fromkeys([text_field, "text"]) if name in schema.names]
    return F.coalesce(*options, F.lit(""))


def is_not_blank(text: Column) -> Column:
    return text.rlike(NOT_BLANK)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, STRIP_PATTERN, "")


def words(text: Column) -> Column:
    """Lower-case word tokens, Unicode aware."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def word_stats(tokens: Column) -> tuple[Column, Column]:
    """Number of words and their total length in characters."""
    return F.size(tokens), F.char_length(F.array_join(tokens, ""))


def quality_ok(
    tokens: Column, min_words: int = 20, min_mean: float = 2.0, max_mean: float = 10.0
) -> Column:
    """At least ``min_words`` words whose mean length lies in the closed interval."""
    count, chars = word_stats(tokens)
    mean = chars / F.greatest(count, F.lit(1))
    return (count >= min_words) & mean.between(min_mean, max_mean)


def with_words(df: DataFrame, text: str = "text", out: str = "words") -> DataFrame:
    """Add the word array, computed once.

    The one-row generator stops a later filter on the array from being pushed below this point,
    which would run the regular expression a second time.
    """
    keep = [F.col(name) for name in df.columns if name != out]
    return df.select(*keep, F.explode(F.array(words(F.col(text)))).alias(out))


def shingles(tokens: Column, size: int = 5) -> Column:
    """Distinct runs of ``size`` words; none when there are fewer words than that."""
    runs = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - (size - 1)),
        lambda i: F.array_join(F.slice(tokens, i, size), " "),
    )
    empty = F.array().cast("array<string>")
    return F.when(F.size(tokens) >= size, F.array_distinct(runs)).otherwise(empty)


def int_div(value: Column, divisor: Column | int) -> Column:
    """Whole-number division, exact for the full bigint range."""
    return F.call_function("div", value, divisor if isinstance(divisor, Column) else F.lit(divisor))


def keep_last(values: Column, limit: int) -> Column:
    """The last ``limit`` items of an array."""
    return F.slice(values, F.greatest(F.size(values) - limit + 1, F.lit(1)), limit)


def append_eos(ids: Column, eos_id: int) -> Column:
    return F.array_append(ids, F.lit(eos_id))
