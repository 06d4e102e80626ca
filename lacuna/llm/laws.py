"""Column functions that the discrete laws of several operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def ln_factorial(x: Column) -> Column:
    """ln x!: Stirling's series for x + 11, brought back by ten factors."""
    z = x + 11.0
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0))) - 1 / (1680 * F.pow(z, F.lit(7.0)))
    product = x + 1.0
    for i in range(2, 11):
        product = product * (x + float(i))
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + series - F.ln(product)


def ln_choose(n: Column, k: Column) -> Column:
    n, k = n.cast("double"), k.cast("double")
    return ln_factorial(n) - ln_factorial(k) - ln_factorial(n - k)
