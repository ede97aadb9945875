"""Display and key text built from columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"  # what to_json writes
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # zone-less event time with microseconds


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters: ``paid_search`` -> ``Paid_Search``.

    ``initcap`` alone breaks words at blanks only.
    """
    pieces = F.split(text, r"(?<=[^\p{L}])")
    return F.array_join(F.transform(pieces, F.initcap), "")


def spaced(name: Column) -> Column:
    return F.replace(name, F.lit("_"), F.lit(" "))


def label(name: Column) -> Column:
    return title_case(spaced(name))


def grouped(number: Column) -> Column:
    """Thousands separators and two decimals."""
    return F.format_number(number, 2)


def whole_grouped(number: Column) -> Column:
    return F.format_number(number.cast("long"), 0)


def clock(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def iso_time(ts: Column) -> Column:
    return F.date_format(ts, ISO_TIME)


def key_time(ts: Column) -> Column:
    """The JSON form of a time with ``:`` and ``.`` turned into ``_``; empty when null."""
    return F.coalesce(F.translate(F.date_format(ts.cast("timestamp"), JSON_TIME), ":.", "__"),
                      F.lit(""))
