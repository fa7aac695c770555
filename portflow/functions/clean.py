"""Cleaning and parsing as column expressions. Nothing here is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from portflow.specs import CANCELED_AFTER_DAYS, VoyageStatus


#: The characters that Unicode calls white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def text(c: Column) -> Column:
    """Trimmed of all Unicode white space; blank is NULL."""
    return F.nullif(F.btrim(c, F.lit(WHITE)), F.lit(""))


def whole(c: Column) -> Column:
    """Strict int; blank or malformed is NULL (see bad_whole)."""
    return text(c).try_cast("int")


def bad_whole(c: Column) -> Column:
    return text(c).isNotNull() & whole(c).isNull()


def day(c: Column) -> Column:
    """YYYYMMDD."""
    return F.try_to_date(text(c), "yyyyMMdd")


def clock(c: Column) -> Column:
    """HHMM as HH:mm, or NULL."""
    t = text(c)
    return F.when(t.rlike("^([01][0-9]|2[0-3])[0-5][0-9]$"), F.concat_ws(":", F.substring(t, 1, 2), F.substring(t, 3, 2)))


def reported_at(c: Column) -> Column:
    """MMDDYYYYHHMM, or MMDDYYYY as midnight; anything else is NULL."""
    t = text(c)  # what is too short for a pattern is not tried on it, as every failure costs an exception
    longer, shorter = (F.when(F.length(c) >= len(p), F.try_to_timestamp(t, F.lit(p))) for p in ("MMddyyyyHHmm", "MMddyyyy"))
    return F.coalesce(longer, shorter)


def classify(work_date: Column, reported: Column) -> Column:
    """Called if work was due by the day after the report, else canceled; NULL if either is unknown."""
    due = work_date <= F.date_add(F.to_date(reported), CANCELED_AFTER_DAYS)
    return F.when(due, F.lit(int(VoyageStatus.CALLED))).when(~due, F.lit(int(VoyageStatus.CANCELED)))
