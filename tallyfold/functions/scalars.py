"""Small column expressions, all evaluated JVM-side."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.pandas.functions import arrow_udf


def component_rank(component: Column, order: Iterable[str]) -> Column:
    """1-based position in the semantic order; NULL for a name outside it."""
    known = F.array(*[F.lit(name) for name in order])
    return F.nullif(F.array_position(known, component), F.lit(0)).cast("int")


def canonical_order(key: str, component: str, order: Iterable[str]) -> list[Column]:
    """Sort columns: key ascending, then semantic component order, unknown components last."""
    return [F.col(key).asc(), component_rank(F.col(component), order).asc_nulls_last()]


def relative_frequency(count: Column, total: Column) -> Column:
    """Percentage of the total; a zero total gives 0.0 instead of a division error."""
    share = count.cast("double") / total.cast("double") * F.lit(100.0)
    return F.when(total == 0, F.lit(0.0)).otherwise(share)


def lookup_label(code: Column, labels: Mapping[str, str], fallback: Column | None = None) -> Column:
    """Display label of a code, ``fallback`` (default NULL) where the code has none."""
    fallback = F.lit(None).cast("string") if fallback is None else fallback
    if not labels:
        return fallback
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), fallback)


def display_round(value: Column, digits: int = 2) -> Column:
    """Round half to even on the scaled double, as tables are shown."""
    scale = F.lit(float(10 ** digits))
    return F.rint(value * scale) / scale


def contains_text(text: Column, needle: str, regex: bool = False) -> Column:
    """Case-insensitive substring (or regex) test; NULL text does not match."""
    if regex:
        found = text.rlike("(?iu)" + needle)
    else:
        found = F.lower(text).contains(F.lower(F.lit(needle)))
    return F.coalesce(found, F.lit(False))


def fixed_decimals(value: Column, digits: int) -> Column:
    """Text with a fixed number of decimals, NULL for NULL, for the few rows of a shown table.

    The double's exact value decides and ties go to the even digit; the JVM's formats round the
    shortest decimal text of the double, ties up.
    """
    @arrow_udf("string")
    def fixed(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else f"{v:.{digits}f}" for v in values.to_pylist()],
                        pa.string())

    return fixed(value.cast("double"))
