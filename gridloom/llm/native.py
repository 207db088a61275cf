"""Small building blocks of DataFrame expressions shared by the operators that run without Python."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that parts words, as a class of Java's regular expressions.
BLANK = r"[\x20\x09-\x0D]"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once however often it is used, inside other lambdas too."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK + "+"), "")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc + x)
