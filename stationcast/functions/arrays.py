"""Array column builders over dense daily series (element ``i`` is day ``start_date + i``).

Everything is a built-in expression (``slice``, ``aggregate``, ``filter``, ``transform`` ...), so it runs in the
JVM next to the scan; no Python row function is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrInt = Column | int | None


def _c(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _bound(v: ColumnOrInt, n: Column, default: Column) -> Column:
    """Python-slice bound normalised to ``[0, n]``: negative counts from the end, overflow clamps."""
    if v is None:
        return default
    v = _c(v)
    return F.when(v < 0, F.greatest(n + v, F.lit(0))).otherwise(F.least(v, n))


def py_slice(arr: Column, lo: ColumnOrInt = None, hi: ColumnOrInt = None) -> Column:
    """``arr[lo:hi]`` with Python semantics (negative ends count from the end, ends clamp, never throws)."""
    n = F.size(arr)
    lo_n = _bound(lo, n, F.lit(0))
    hi_n = _bound(hi, n, n)
    return F.slice(arr, lo_n + 1, F.greatest(hi_n - lo_n, F.lit(0)))


def pad_to(arr: Column, n: Column | int) -> Column:
    """Append zeros until the array holds ``n`` elements (no change when it is already that long)."""
    missing = F.greatest(_c(n) - F.size(arr), F.lit(0))
    return F.concat(arr, F.array_repeat(F.lit(0).cast("bigint"), missing.cast("int")))


def array_sum(arr: Column, zero: Column | None = None) -> Column:
    """Sum of the elements; a NULL element counts as 0, an empty array sums to ``zero`` (0 by default)."""
    start = zero if zero is not None else F.lit(0).cast("bigint")
    return F.aggregate(arr, start, lambda acc, x: acc + F.coalesce(x, F.lit(0)))


def array_dsum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def trailing_sum(arr: Column, n: int) -> Column:
    """Sum of the last ``n`` elements."""
    return array_sum(py_slice(arr, -n, None))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a lambda variable.

    Spark does not share a sub-expression between the places that use it inside higher-order functions, so a
    statistic used per element would be recomputed per element; binding it first keeps the work linear.
    """
    return F.transform(F.array(value), body).getItem(0)


#: Below this product of length and largest value the inlier test stays within 64 bits.
SMALL = 1_500_000_000


def _window_stats(w: Column, kind: str) -> Column:
    num = lambda x: x.cast(kind)
    return F.struct(num(F.size(w)).alias("k"),
                    F.aggregate(w, num(F.lit(0)), lambda acc, x: num(acc + x)).alias("s"),
                    F.aggregate(w, num(F.lit(0)), lambda acc, x: num(acc + num(x) * num(x))).alias("q"))


def _inside(st: Column, x: Column) -> Column:
    """``mean - std < x < mean + std`` (population std), evaluated exactly in integers.

    With ``S = sum x``, ``Q = sum x^2`` and ``k`` elements the test is ``(k*x - S)^2 < k*Q - S^2``: the same
    inequality multiplied out, so no rounding can move a value across a bound.
    """
    dev = st["k"] * x - st["s"]
    return dev * dev < st["k"] * st["q"] - st["s"] * st["s"]


def _exact(w: Column, body) -> Column:
    """``body(element type)`` in BIGINT where nothing can overflow, else in 38 digits: the same result, but the wide
    type costs several times as much."""
    largest = F.array_max(F.transform(w, lambda x: F.abs(x.cast("decimal(19,0)"))))
    small = F.coalesce(largest * F.size(w) < SMALL, F.lit(True))
    return F.when(small, body("bigint")).otherwise(body("decimal(38,0)"))


def median_sorted(sorted_arr: Column) -> Column:
    """Median of an ascending array: middle element, or the mean of the middle pair; NULL when empty."""
    m = F.size(sorted_arr)
    odd = F.try_element_at(sorted_arr, ((m + 1) / 2).cast("int")).cast("double")
    lo = F.try_element_at(sorted_arr, F.greatest((m / 2).cast("int"), F.lit(1))).cast("double")
    hi = F.try_element_at(sorted_arr, F.least((m / 2).cast("int") + 1, m)).cast("double")
    return F.when(m == 0, F.lit(None).cast("double")).when(m % 2 == 1, odd).otherwise((lo + hi) / 2.0)


def clean_values(w: Column) -> Column:
    """Outliers of ``w`` replaced by the median of the strict inliers; NULL when ``w`` is empty, holds a NULL
    day, or has no strict inlier (an all-equal window, for example)."""
    def cleaned(kind):
        def with_stats(st):
            def inside(x):
                return _inside(st, x.cast("decimal(19,0)") if kind != "bigint" else x)

            def with_inliers(inl):
                values = let(median_sorted(inl), lambda med: F.transform(
                    w, lambda x: F.when(inside(x), x.cast("double")).otherwise(med)))
                return F.when((F.size(w) > 0) & (F.size(inl) > 0), values)
            return let(F.array_sort(F.filter(w, inside)), with_inliers)
        return let(_window_stats(w, kind), with_stats)
    usable = ~F.exists(w, lambda x: x.isNull())
    return F.when(usable, _exact(w, cleaned))


def clean_window(src: Column, lo: Column, hi: Column) -> Column:
    """``src[lo:hi]`` cleaned by ``clean_values``; NULL when an end is negative or the window fails."""
    return F.when((lo >= 0) & (hi >= 0), let(py_slice(src, lo, hi), clean_values))


def scale_crossmean(x: Column, y: Column) -> Column:
    """Mean over all pairs ``(a in x, b in y)`` of ``a / b`` when ``b > 0``, else 1, in closed form.

    ``(sum(x) * sum_{b>0} 1/b + |x| * #{b <= 0}) / (|x| * |y|)``: linear instead of a ``|x| * |y|`` product.
    """
    nx = F.size(x).cast("double")
    ny = F.size(y).cast("double")
    sx = F.aggregate(x, F.lit(0.0), lambda a, v: a + v.cast("double"))
    inv = F.aggregate(F.filter(y, lambda b: b > 0), F.lit(0.0), lambda a, b: a + 1.0 / b.cast("double"))
    nonpos = F.size(F.filter(y, lambda b: b <= 0)).cast("double")
    return F.when((nx > 0) & (ny > 0), (sx * inv + nx * nonpos) / (nx * ny))


def rolling_week_sums(arr: Column, end_offset: Column | int, count: int = 9, width: int = 7) -> Column:
    """``count`` sums of ``width`` consecutive days, one-day stride, oldest first.

    Sum ``j`` (``j = count .. 1``) covers ``arr[end - j - width : end - j]`` in Python slice terms, where ``end`` is
    a non-positive offset from the end of ``arr`` (``0`` = the end itself).
    """
    end = _c(end_offset)
    return F.transform(
        F.sequence(F.lit(count), F.lit(1), F.lit(-1)),
        lambda j: array_sum(py_slice(arr, end - j - width, end - j)),
    )
