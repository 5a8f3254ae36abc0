"""The visitor hash behind the bitmap unique-visitor count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The polynomial's base, and the bitmap's size as a power of two.
SEED = 61
BITMAP_BITS = 29

# Decimal digits of the longest LONG.
_DIGITS = 19


def visitor_slot(user_id: str, bits: int = BITMAP_BITS, seed: int = SEED) -> Column:
    """Bitmap position of a LONG id column: base-``seed`` polynomial of its decimal text, mod 2^bits.

    The text is never built. A digit's place in it fixes its coefficient, so the polynomial
    is a sum over places with constant coefficients, all arithmetic and inside generated
    code. Coefficients are reduced mod 2^bits first: the sum stays far below 2^63.
    """
    if not 1 <= bits <= 48:
        raise ValueError("bits must be between 1 and 48")
    modulus = 1 << bits
    zero, minus = ord("0"), ord("-")
    negative = f"(`{user_id}` < 0)"
    # Minus the absolute value, which exists for every LONG.
    below_zero = f"(CASE WHEN {negative} THEN `{user_id}` ELSE -`{user_id}` END)"
    terms = [f"(CASE WHEN {negative} THEN {minus}L ELSE 0L END)"]
    for place in range(_DIGITS):
        power, coefficient = 10**place, pow(seed, place, modulus)
        # A minus sign stands before the digits: every digit moves it one place on.
        sign_moved = minus * (pow(seed, place + 1, modulus) - coefficient) % modulus
        terms.append(
            f"(CASE WHEN {power == 1} OR {below_zero} <= -{power}L"
            f" THEN ({zero}L - ({below_zero} div {power}L) % 10L) * {coefficient}L"
            f" + (CASE WHEN {negative} THEN {sign_moved}L ELSE 0L END) ELSE 0L END)"
        )
    return F.expr(f"CASE WHEN `{user_id}` IS NOT NULL THEN ({' + '.join(terms)}) & {modulus - 1}L END")
