"""Exact half-up rounding of normalized scores in integer arithmetic."""

from __future__ import annotations

from riskweave.models import ModelSpec

# Coefficients are held as integers in units of 10 ** -COEF_DECIMALS.
COEF_DECIMALS = 9


def normalized_score(units: str, spec: ModelSpec) -> str:
    """SQL text: coefficient units -> score with three decimals as a double.

    The sum times coding intensity over normalization is rounded half away from zero to
    thousandths.  Binary floating point would misplace sums that fall exactly on a half.
    """
    divisor = spec.normalization_millis * 10 ** (COEF_DECIMALS - 3)
    rounded = (
        f"(2L * abs({units}) * {spec.coding_intensity_millis}L + {divisor}L) div {2 * divisor}L"
    )
    return f"cast(case when {units} < 0 then -({rounded}) else {rounded} end as double) / 1000D"
