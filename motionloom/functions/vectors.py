"""Column functions on array<double> vectors and on rotations. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(x: Column | str) -> Column:
    """Six decimals, and no negative zero."""
    return F.round(F.col(x) if isinstance(x, str) else x, 6) + F.lit(0.0)


def finite(x: Column) -> Column:
    """x, or null where it is null, NaN or infinite."""
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def scaled(v: Column, k: float) -> Column:
    return F.transform(v, lambda x: x * F.lit(k))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def cross(a: Column, b: Column) -> Column:
    a0, a1, a2, b0, b1, b2 = a[0], a[1], a[2], b[0], b[1], b[2]
    return F.array(a1 * b2 - a2 * b1, a2 * b0 - a0 * b2, a0 * b1 - a1 * b0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unit(v: Column, eps: float = 1e-12) -> Column:
    return let(F.greatest(norm(v), F.lit(eps)), lambda n: F.transform(v, lambda x: x / n))


def xyz_to_state_frame(p: Column) -> Column:
    """Action axes z, x, y in that order."""
    return F.array(p[2], p[0], p[1])


def quaternion_to_rot6d(q: Column) -> Column:
    """xyzw, normalised, to the first two rows of its matrix; null for a wrong size or a zero quaternion."""
    n = norm(q)
    x, y, z, w = (q[i] / n for i in range(4))
    rows = F.array(1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w))
    return F.when((F.size(q) == 4) & (n > 0), rows)


def action_quaternion_to_rot6d(q: Column) -> Column:
    """The same in the state's frame: a fixed permutation of rows and columns with signs."""
    n = norm(q)
    x, y, z, w = (q[i] / n for i in range(4))
    r = [[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]]
    rows = F.array(r[2][2], -r[2][0], -r[2][1], r[0][2], -r[0][0], -r[0][1])
    return F.when((F.size(q) == 4) & (n > 0), rows)


def rot6d_rows(r: Column, column_major: bool = False) -> Column:
    """Six numbers to the three rows of a rotation by Gram-Schmidt; they are its first two rows, or columns if column_major is set."""
    a, b = F.slice(r, 1, 3), F.slice(r, 4, 3)
    across = lambda first: let(dot(first, b), lambda along: unit(F.zip_with(b, first, lambda y, x: y - along * x)))
    found = let(unit(a), lambda first: let(across(first), lambda second: F.array(first, second, cross(first, second))))
    return transposed(found) if column_major else found


def transposed(rows: Column) -> Column:
    return F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda i: F.transform(rows, lambda row: F.get(row, i)))


def rows_to_rot6d(rows: Column) -> Column:
    return let(rows, lambda r: F.concat(r[0], r[1]))


def angle_degrees(trace: Column) -> Column:
    inside = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (trace - 1) / 2))  # these two skip nulls
    return F.when(trace.isNotNull(), F.degrees(F.acos(inside)))


def rotation_between(a: Column, b: Column) -> Column:
    """Degrees between two rotations given as rows: the trace of one transposed times the other is the sum of products."""
    return angle_degrees(dot(a[0], b[0]) + dot(a[1], b[1]) + dot(a[2], b[2]))


def normalised(x: Column, low: Column, high: Column) -> Column:
    """low and high to -1 and 1; a range under 1e-8 counts as 1e-8."""
    return 2 * (x - low) / F.greatest(high - low, F.lit(1e-8)) - 1
