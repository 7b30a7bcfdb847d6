"""Amounts in one currency, exact at any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal, localcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvault.functions.exact import SUM_LIMBS, limbs, number_limbs, total_text, totals

Rates = Mapping[str, Decimal | int | float | str]

RATE_DIGITS = 38  # of a rate that its base doesn't divide


def normalised_rates(preferred: str, rates: Rates | None) -> dict[str, Decimal]:
    """Rates relative to the preferred currency; without its own rate it counts as 1.

    A quotient keeps its first 38 digits, wherever its point is; a rate over 1 keeps all of its own.
    """
    if rates is None:
        return {}
    exact = {currency: Decimal(str(rate)) for currency, rate in rates.items()}
    for currency, rate in exact.items():
        if not rate.is_finite() or rate <= 0:
            raise ValueError(f"exchange rate of {currency} must be a positive number, got {rate}")
    base = exact.get(preferred, Decimal(1))
    if base == 1:
        return exact
    with localcontext(prec=RATE_DIGITS):
        return {currency: rate / base for currency, rate in exact.items()}


def exact_amount(name: str) -> str:
    """SQL of the plain text of a stored amount, from its decimal or from its wide column."""
    return f"coalesce(cast({name} AS string), {name}_wide)"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def known_currencies(preferred: str, rates: Rates | None) -> list[str]:
    return sorted({preferred, *normalised_rates(preferred, rates)})


def _rate_limbs(currency: str, preferred: str, rates: Rates | None) -> str:
    """SQL of the limbs of the rate of a row's currency, NULL when there is none.

    The rates are a handful of driver-side numbers and become literals of a CASE expression, so
    there is no join.
    """
    table = normalised_rates(preferred, rates) | {preferred: Decimal(1)}

    def array(rate: Decimal) -> str:
        pairs = [f"named_struct('place', {place}, 'part', {part}BD)" for place, part in number_limbs(rate)]
        return f"array({', '.join(pairs)})"

    cases = " ".join(f"WHEN {_literal(code)} THEN {array(rate)}" for code, rate in sorted(table.items()))
    return f"CASE {currency} {cases} END"


def _products(parts: str, rate: str) -> str:
    """Limbs of a product from the limbs of its factors; places may repeat."""
    one = "named_struct('place', x.place + r.place, 'part', cast(cast(x.part AS decimal(28,0)) * r.part AS decimal(38,0)))"
    return f"flatten(transform({parts}, x -> transform({rate}, r -> {one})))"


def converted_amount(text: str, currency: str, preferred: str, rates: Rates | None) -> str:
    """SQL of an amount (plain text) in the preferred currency, as plain text and without rounding.

    NULL when there is no rate for its currency. An amount in the preferred currency stays as it is.
    """
    rate = _rate_limbs(currency, preferred, rates)
    known = f"{currency} IN ({', '.join(_literal(c) for c in known_currencies(preferred, rates))})"
    return f"CASE WHEN {text} IS NOT NULL AND {known} THEN {total_text(_products(limbs(text), rate))} END"


def converted_totals(
    parts: DataFrame, keys: Sequence[str], preferred: str, rates: Rates | None, name: str
) -> DataFrame:
    """(*keys, name): sums (*keys, currency, place, whole, fraction) per currency, as one in the preferred one.

    Sums are converted, not their amounts: the product of a sum is exact, so both are the same.
    """
    rate = _rate_limbs("currency", preferred, rates)
    converted = parts.select(*keys, F.expr(f"inline({_products(SUM_LIMBS, rate)})"))
    return totals(converted, keys, name)
