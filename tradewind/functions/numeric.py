"""Exact decimal helpers; no double enters an amount."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
QUANTITY = "decimal(18,3)"


def _col(c: Column | str) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def round_money(c: Column | str) -> Column:
    return F.round(_col(c), 2).cast(MONEY)


def exact_ratio(num: Column | str, den: Column | str, scale: int) -> Column:
    """num / den rounded half away from zero to `scale` digits, in one integral division.

    A plain decimal division rounds at its own scale first, and rounding that
    again moves ties. NULL when `den` is zero or either side is NULL.
    Integer arguments must be cast to a decimal by the caller. Text is SQL: a name or an expression.
    """
    if isinstance(num, str) and isinstance(den, str):
        # names or SQL text on both sides: the whole quotient is one parsed expression
        whole = f"((abs({num}) * {2 * 10**scale} + abs({den})) div nullif(abs({den}) * 2, 0))"
        signed = f"if((({num}) < 0) != (({den}) < 0), -{whole}, {whole})"
        return F.expr(f"cast({signed} as decimal(18,0)) * {Decimal(1).scaleb(-scale):f}BD")
    num, den = _col(num), _col(den)
    twice = F.abs(den) * F.lit(2)
    scaled = F.abs(num) * F.lit(2 * 10**scale) + F.abs(den)
    whole = F.call_function("div", scaled, F.nullif(twice, F.lit(0)))
    signed = F.when((num < 0) != (den < 0), -whole).otherwise(whole)
    return signed.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-scale))
