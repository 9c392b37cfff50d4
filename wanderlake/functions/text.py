"""Text expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderlake.fixed_values import SURROGATE_NULL, SURROGATE_SEPARATOR

# Characters removed where the contract strips every kind of white space, not only spaces.
ALL_WHITE_SPACE = " \t\n\r\x0b\x0c"


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column in a single projection."""
    return df.select(
        *[
            F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def upper_names(df: DataFrame) -> DataFrame:
    """The same rows under upper-case column names."""
    return df.toDF(*[name.upper() for name in df.columns])


def tidy_lower(value: Column) -> Column:
    return F.lower(F.trim(value))


def tidy_upper(value: Column) -> Column:
    return F.upper(F.trim(value))


def blank_to_null(value: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(value), F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """Both trimmed names with a space between; NULL when either is NULL."""
    return F.concat(F.trim(first), F.lit(" "), F.trim(last))


def mapped(value: Column, table: Mapping[str, str], default: str) -> Column:
    """Look a value up in a small fixed table; unknown and NULL give the default."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(default))


def is_true_text(value: Column, accepted: Iterable[str], ignore_case: bool) -> Column:
    """True when the value's text is one of ``accepted``; everything else, NULL too, is false."""
    text = value.cast("string")
    if ignore_case:
        text = F.lower(text)
    return F.coalesce(text.isin(*accepted), F.lit(False))


def surrogate_key(*parts: Column) -> Column:
    """MD5 text over the natural key's parts."""
    shown = [F.coalesce(part.cast("string"), F.lit(SURROGATE_NULL)) for part in parts]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *shown))


def packed_key(key: Column) -> Column:
    """A key's text in bytes: 16 for the 32 hexadecimal digits of a surrogate key, more than 16 for any other text.

    Digests do not compress, so their text takes twice the room in a shuffle.
    """
    # Decoded once: text in other digits than hexadecimal ones gives NULL there.
    digest = F.unhex(F.when((F.octet_length(key) == 32) & (F.lower(key) == key), key))
    return F.coalesce(digest, F.concat(key.cast("binary"), F.lit(bytes(17))))


def unpacked_key(packed: Column) -> Column:
    """The text that ``packed_key`` got."""
    other = F.substring(packed, F.lit(1), F.length(packed) - 17).cast("string")
    return F.when(F.length(packed) == 16, F.lower(F.hex(packed))).otherwise(other)


def surrogate_columns(df: DataFrame) -> list[str]:
    """Names of the text columns that hold surrogate keys."""
    return [f.name for f in df.schema.fields if f.name.endswith("_sk") and isinstance(f.dataType, T.StringType)]


def keys_packed(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({name: packed_key(F.col(f"`{name}`")) for name in names})


def keys_unpacked(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({name: unpacked_key(F.col(f"`{name}`")) for name in names})
