"""Number functions: amounts, ratios, tests and validation rules."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelforge.constants import DISCOUNT_RATE


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def total_price(price: Column | str, quantity: Column | str) -> Column:
    return _column(price) * _column(quantity)


def discounted(price: Column | str, rate: float = DISCOUNT_RATE) -> Column:
    return _column(price) * F.lit(rate)


def is_integer_valued(text: Column | str) -> Column:
    """5 and 5.0 are integer-valued; 5.5, and text that is no finite number, are not."""
    number = _column(text).try_cast("double")
    whole = (number == F.floor(number).cast("double")) & (F.abs(number) != float("inf")) & ~F.isnan(number)
    return F.coalesce(whole, F.lit(False))


def rescale(value: Column | str, reference: Column | str, own: Column | str) -> Column:
    """``value * reference / own``; null when ``own`` is zero."""
    own = _column(own)
    return _column(value) * (_column(reference) / F.nullif(own, F.lit(0.0)))


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules whose condition does not hold, as an array. A null condition breaks its rule."""
    checks = [F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()]
    return F.array_compact(F.array(*checks))
