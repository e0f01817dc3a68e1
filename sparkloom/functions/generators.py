"""Row generators and user functions for what built-in expressions cannot say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import tokens


@F.udtf(returnType="position int, word string")
class Words:
    """One row per word of a text: the general form of a function that yields many rows."""

    def eval(self, text: str):
        if text is not None:
            for position, word in enumerate(text.upper().replace("-", " ").split()):
                yield position, word


def words_by_generator(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, text).lateralJoin(Words(F.col(text).outer())).select(key, "position", "word")


def words_by_explode(df: DataFrame, key: str, text: str) -> DataFrame:
    """The same rows by a built-in generator, without leaving the JVM; use this one."""
    return df.select(key, F.posexplode(tokens(F.col(text))).alias("position", "word"))


def geometric_mean(value: Column) -> Column:
    """A custom aggregate written with built-in ones, so it is combined before the shuffle."""
    return F.exp(F.avg(F.log(value)))


def demeaned(value: Column, mean: Column) -> Column:
    return value - mean
