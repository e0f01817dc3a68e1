"""Text column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def find(text: Column, part: str) -> Column:
    """0-based position, -1 where absent."""
    return F.instr(text, part) - 1


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of the group; null where the pattern does not match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def part_of(text: Column, sep: str, index: int) -> Column:
    """0-based part of a split, null past the end."""
    return F.get(F.split(text, sep, -1), F.lit(index))


def key_of(*cols: str, sep: str = "~") -> Column:
    """Join columns to one key; nulls count as empty text."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def initial(name: Column) -> Column:
    """First name to initial: ``Ada Lovelace`` gives ``A. Lovelace``."""
    return F.regexp_replace(name, r"^(\S)\S*[ #]", "$1. ")


def raw_tokens(text: Column) -> Column:
    """Upper-case words split at hyphens and white space; may hold empty words."""
    return F.split(F.upper(text), r"[-\s]+")


def tokens(text: Column) -> Column:
    """Upper-case words; hyphens separate words."""
    return F.filter(raw_tokens(text), lambda w: w != "")


def token_rows(df: DataFrame, keys: list[str] | str, text: str, distinct: bool = False, out: str = "token") -> DataFrame:
    """One row per word; empty words are dropped after the unfolding, in generated code."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    words = raw_tokens(F.col(text))
    return df.select(*keys, F.explode(F.array_distinct(words) if distinct else words).alias(out)).filter(F.col(out) != "")


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


@F.pandas_udf(StringType())
def fold(text: pd.Series) -> pd.Series:
    """Composed form with case folded, for caseless comparison."""
    return text.map(lambda s: unicodedata.normalize("NFC", s).casefold(), na_action="ignore")


@F.pandas_udf(StringType())
def strip_marks(text: pd.Series) -> pd.Series:
    """Remove diacritic marks from all letters."""
    def plain(s: str) -> str:
        bare = "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c))
        return unicodedata.normalize("NFC", bare)
    return text.map(plain, na_action="ignore")
