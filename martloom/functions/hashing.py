"""Hash keys over several columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.columns import as_col


def hash_key(*cols: str | Column, skip_nulls: bool = False, separator: str = "|") -> Column:
    """SHA-256 over the texts of ``cols``.

    A NULL counts as empty text, so that (a, NULL, b) and (a, b, NULL) get
    different keys; ``skip_nulls`` leaves NULLs out instead, for keys that
    older tables already hold. Pass amounts as decimals: the text of a
    double depends on who prints it.
    """
    texts = [as_col(c).cast("string") for c in cols]
    if not skip_nulls:
        texts = [F.coalesce(t, F.lit("")) for t in texts]
    return F.sha2(F.concat_ws(separator, *texts), 256)


def amount_text(c: str | Column) -> Column:
    """``12,345.68``, the text form of an amount inside landed hash keys."""
    return F.format_number(as_col(c), 2)
