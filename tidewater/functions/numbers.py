"""Numeric column functions (M1-M4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.text import ColumnOrName, _c


def round_half_even_int(c: ColumnOrName) -> Column:
    """Half-to-even rounding to a nullable 64-bit integer (2.5 -> 2, 3.5 -> 4); beyond its range -> null."""
    return F.bround(_c(c), 0).try_cast("bigint")


def local_number(c: ColumnOrName) -> Column:
    """M2: parse ``1.234,56`` (dot thousands, comma decimals) to double; bad text -> null.

    Dots are removed literally (N13), then the comma becomes the decimal point.
    """
    from tidewater.functions.names import guarded_cast
    x = F.replace(_c(c), F.lit("."), F.lit(""))
    x = F.replace(x, F.lit(","), F.lit("."))
    return guarded_cast(x, "double")


def tax_inclusive(net: ColumnOrName, tax_code: ColumnOrName, exempt_code: str = "IVA_EXE",
                  rate: float = 1.19) -> Column:
    """M3: exempt code keeps the net amount, any other code (null counts as ``_``) multiplies by ``rate``."""
    code = F.coalesce(_c(tax_code), F.lit("_"))
    return F.when(code == F.lit(exempt_code), _c(net)).otherwise(_c(net) * F.lit(rate))


def difference_where_null(key: ColumnOrName, a: ColumnOrName, b: ColumnOrName) -> Column:
    """M4: ``a - b`` where ``key`` is null, else ``b``."""
    return F.when(_c(key).isNull(), _c(a) - _c(b)).otherwise(_c(b))
