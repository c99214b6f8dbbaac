"""Seeded affine hash family, as Spark column expressions and as SQL text.

``h(x) = ((a*x + b) mod p) mod m`` with ``a`` in ``[1, p-1]``, ``b`` in
``[0, p-1]``.  The argument is reduced modulo ``p`` first, so ``a * x`` never
overflows BIGINT (ANSI mode raises on overflow) and the value equals the plain
integer formula for every ``x``, negative ones included (``((x % p) + p) % p``).

The expressions are written once, as SQL text: Spark parses each into a
single Column, and the DuckDB oracle runs the same text with the same
literals drawn from a seed.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the prime modulus of the hash family.
P = 8191


@dataclass(frozen=True)
class Affine:
    """One member of the family: ``x -> (a*x + b) mod p``."""

    a: int
    b: int
    p: int = P


@dataclass(frozen=True)
class EdgeBucket:
    """Bucket of an ordered pair: ``(a*u + b*v + c) mod p``."""

    a: int
    b: int
    c: int
    p: int = P


# Fixed value: the prime modulus of the polynomial family, 2^31 - 1; products of two
# residues stay below 2^62, so BIGINT arithmetic is exact.
P_POLY = 2147483647


def draw_poly(rng: random.Random, degree: int = 3, p: int = P_POLY) -> tuple[int, ...]:
    """Coefficients, highest first, of a random polynomial: ``degree + 1``-wise
    independent values at distinct residues modulo ``p``."""
    return (rng.randint(1, p - 1), *(rng.randint(0, p - 1) for _ in range(degree)))


def draw_affine(seed: int, n: int, p: int = P) -> list[Affine]:
    """``n`` independent members drawn from an explicit seed."""
    rng = random.Random(seed)
    return [Affine(rng.randint(1, p - 1), rng.randint(0, p - 1), p) for _ in range(n)]


def draw_edge_bucket(seed: int, p: int = P) -> EdgeBucket:
    rng = random.Random(seed)
    return EdgeBucket(rng.randint(1, p - 1), rng.randint(1, p - 1), rng.randint(0, p - 1), p)


def affine(x: str, a, b, p: int = P) -> Column:
    """``(a*x + b) mod p``; ``x``, ``a``, ``b`` are SQL expressions (column
    names, struct fields) or integers."""
    return F.expr(sql_affine(x, a, b, p))


def color(x: str, a, b, m, p: int = P) -> Column:
    """Colour / column index ``((a*x + b) mod p) mod m`` in ``[0, m)``."""
    return F.expr(sql_color(x, a, b, m, p))


def sign(x: str, a, b, p: int = P) -> Column:
    """Sign ``2*(((a*x + b) mod p) mod 2) - 1`` in ``{-1, +1}``."""
    return F.expr(sql_sign(x, a, b, p))


def edge_bucket(u: str, v: str, h: EdgeBucket, m) -> Column:
    """Bucket of the ordered pair ``(u, v)`` in ``[0, m)``."""
    return F.expr(sql_edge_bucket(u, v, h, m))


# ---- the formulas as SQL text: Spark parses them into one expression each
# (no per-operator Python round trips), and DuckDB runs the same text ----

def sql_pmod(x: str, p: int = P) -> str:
    return f"(((CAST({x} AS BIGINT)) % {p}) + {p}) % {p}"


def sql_affine(x: str, a, b, p: int = P) -> str:
    return f"(({sql_pmod(x, p)}) * {a} + {b}) % {p}"


def sql_color(x: str, a, b, m, p: int = P) -> str:
    return f"({sql_affine(x, a, b, p)}) % {m}"


def sql_sign(x: str, a, b, p: int = P) -> str:
    return f"((({sql_affine(x, a, b, p)}) % 2) * 2 - 1)"


def sql_edge_bucket(u: str, v: str, h: EdgeBucket, m) -> str:
    return (f"(({sql_pmod(u, h.p)}) * {h.a} + ({sql_pmod(v, h.p)}) * {h.b} + {h.c})"
            f" % {h.p} % {m}")


def sql_poly(residue: str, coefficients, p: int = P_POLY) -> str:
    """Value modulo ``p`` of a polynomial (highest coefficient first) at a residue
    in ``[0, p)``, by Horner's rule."""
    first, *rest = coefficients
    value = f"CAST({first} AS BIGINT)"
    for c in rest:
        value = f"(({value}) * {residue} + {c}) % {p}"
    return value
