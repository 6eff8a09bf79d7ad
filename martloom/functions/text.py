"""Text clean-up used by keys and lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.columns import as_col


def norm_text(c: str | Column) -> Column:
    """Upper-case without outer blanks, for joins on free text."""
    return F.upper(F.trim(as_col(c)))


def blank_to_null(c: str | Column) -> Column:
    return F.when(F.trim(as_col(c)) != "", as_col(c))


def digits_only(c: str | Column) -> Column:
    return F.regexp_replace(as_col(c), "[^0-9]", "")


def trailing_id(c: str | Column) -> Column:
    """Number at the end of a URI, NULL when there is none."""
    return F.regexp_extract(as_col(c), r"(\d+)$", 1).try_cast("bigint")


def id_after(c: str | Column, segment: str) -> Column:
    """Number that follows ``/segment/`` in a URI, NULL when there is none."""
    return F.regexp_extract(as_col(c), rf"/{segment}/(\d+)", 1).try_cast("bigint")


def tax_id_or_name(tax_id_digits: str | Column, name: str | Column) -> Column:
    """Natural key of a supplier: its cleaned tax id, else its name."""
    return F.coalesce(blank_to_null(tax_id_digits), as_col(name))


# Length of a cleaned tax id -> kind of person.
PARTY_KINDS = {14: "PJ", 11: "PF"}
PARTY_KIND_UNKNOWN = "NAO_IDENTIFICADO"


def party_kind(
    tax_id_digits: str | Column,
    kinds: dict[int, str] = PARTY_KINDS,
    otherwise: str = PARTY_KIND_UNKNOWN,
) -> Column:
    size = F.length(as_col(tax_id_digits))
    return F.coalesce(
        *[F.when(size == length, F.lit(kind)) for length, kind in kinds.items()],
        F.lit(otherwise),
    )
