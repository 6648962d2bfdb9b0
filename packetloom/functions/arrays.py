"""Per-packet array expressions: one packet's channels are one ARRAY column.

Everything is a Column built from Spark's higher-order functions, so it stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOAT32_TINY = 1.1754943508222875e-38   # fixed value: smallest normal float32
FLOAT32_EPS = 1.1920928955078125e-07    # fixed value: float32 machine epsilon


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, use) -> Column:
    """Evaluate ``value`` once per row and hand it to ``use``.

    What a lambda refers to is evaluated again for every element; a large array or a mean inside
    one would make a packet quadratic.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def as_floats(c) -> Column:
    return F.transform(_col(c), lambda x: x.cast("float"))


def as_doubles(c) -> Column:
    return F.transform(_col(c), lambda x: x.cast("double"))


def amplitude(real, imag) -> Column:
    return F.zip_with(_col(real), _col(imag), lambda r, i: F.hypot(r, i).cast("float"))


def phase(real, imag) -> Column:
    return F.zip_with(_col(imag), _col(real), lambda i, r: F.atan2(i, r).cast("float"))


def polar_real(amp, angle) -> Column:
    return F.zip_with(_col(amp), _col(angle), lambda a, p: (a * F.cos(p)).cast("float"))


def polar_imag(amp, angle) -> Column:
    return F.zip_with(_col(amp), _col(angle), lambda a, p: (a * F.sin(p)).cast("float"))


def take(c, indices) -> Column:
    """The elements at ``indices`` (an array Column), those outside the array left out."""
    return bind(_col(c), lambda arr: F.transform(
        F.filter(_col(indices), lambda i: (i >= 0) & (i < F.size(arr))), lambda i: F.get(arr, i)))


def kept_indices(c, indices) -> Column:
    arr, idx = _col(c), _col(indices)
    return F.filter(idx, lambda i: (i >= 0) & (i < F.size(arr)))


def drop_indices(c, indices) -> Column:
    return bind(_col(indices), lambda drop: F.filter(
        _col(c), lambda x, i: ~F.array_contains(drop, i)))


def index_array(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(int(v)) for v in values])


def interleaved_imag(c) -> Column:
    return F.filter(_col(c), lambda x, i: i % 2 == 0)


def interleaved_real(c) -> Column:
    return F.filter(_col(c), lambda x, i: i % 2 == 1)


def fft_shift(c) -> Column:
    arr = _col(c)
    half = F.ceil(F.size(arr) / F.lit(2)).cast("int")
    return F.when(F.size(arr) < 2, arr).otherwise(
        F.concat(F.slice(arr, half + 1, F.size(arr)), F.slice(arr, F.lit(1), half)))


def every(c, k: int) -> Column:
    return F.filter(_col(c), lambda x, i: i % k == 0)


def affine(c, mean: float, scale: float) -> Column:
    return F.transform(_col(c), lambda x: ((x - F.lit(mean)) / F.lit(scale)).cast("float"))


def total(c) -> Column:
    return F.aggregate(_col(c), F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def mean(c) -> Column:
    arr = _col(c)
    return F.when(F.size(arr) > 0, total(arr) / F.size(arr))


def divide_by_mean(c, reference=None) -> Column:
    """Divide by the mean of ``reference`` (the amplitude of the packet), never by less than eps."""
    base = _col(c if reference is None else reference)
    scale = F.greatest(mean(base), F.lit(FLOAT32_EPS))
    return bind(scale, lambda s: F.transform(_col(c), lambda x: (x / s).cast("float")))


def is_finite(x: Column) -> Column:
    d = x.cast("double")
    return d.isNotNull() & ~F.isnan(d) & (F.abs(d) != F.lit(float("inf")))


def repair_nonfinite(c) -> Column:
    arr = _col(c)
    fill = F.coalesce(mean(F.filter(arr, is_finite)), F.lit(0.0)).cast("float")
    return bind(fill, lambda f: F.transform(arr, lambda x: F.when(is_finite(x), x).otherwise(f)))


def any_nonzero(c) -> Column:
    return F.exists(_col(c), lambda x: x != 0)


def permute(c, sizes: Sequence, order: Sequence[int]) -> Column:
    """Reorder the axes of a row-major tensor of ``sizes`` so that new axis i is old ``order[i]``.

    ``sizes`` may hold ints or integer Columns, so shapes may differ between rows.
    """
    if sorted(order) != list(range(len(sizes))):
        raise ValueError(f"axis order {list(order)} is not a permutation of {len(sizes)} axes")
    size = [F.lit(s) if isinstance(s, int) else s for s in sizes]

    def stride(axis: int) -> Column:
        out = F.lit(1)
        for s in size[axis + 1:]:
            out = out * s
        return out

    target = [size[a] for a in order]

    def source(k: Column) -> Column:
        rest, position = k, F.lit(0)
        for axis in reversed(range(len(target))):
            position = position + (rest % target[axis]) * stride(order[axis])
            rest = F.floor(rest / target[axis])
        return position.cast("int")

    return bind(_col(c), lambda arr: F.when(F.size(arr) == 0, arr).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(arr) - 1), lambda k: F.get(arr, source(k)))))


def fit_axis(c, outer, length, inner, target: int, centred: bool = False, fill=0.0) -> Column:
    """Crop or pad one axis of a row-major tensor seen as ``outer x length x inner``."""
    outer, length, inner = [F.lit(v) if isinstance(v, int) else v for v in (outer, length, inner)]
    shift = F.lit(0)
    if centred:
        shift = F.when(length > target, F.floor((length - target) / 2)).otherwise(
            -F.floor((F.lit(target) - length) / 2))

    def cell(arr: Column, k: Column) -> Column:
        o = F.floor(k / (inner * target))
        p = F.floor(k / inner) % target + shift
        i = k % inner
        return F.when((p >= 0) & (p < length), F.get(arr, ((o * length + p) * inner + i).cast("int"))
                      ).otherwise(F.lit(fill).cast("float"))

    return bind(_col(c), lambda arr: F.transform(
        F.sequence(F.lit(0), (outer * target * inner - 1).cast("int")), lambda k: cell(arr, k)))


def axis_reduce(c, outer, length, inner, how: str = "sum") -> Column:
    """Sum or average away one axis of a row-major tensor seen as ``outer x length x inner``."""
    outer, length, inner = [F.lit(v) if isinstance(v, int) else v for v in (outer, length, inner)]

    def cell(arr: Column, k: Column) -> Column:
        o, i = F.floor(k / inner), k % inner
        parts = F.transform(F.sequence(F.lit(0), (length - 1).cast("int")),
                            lambda p: F.get(arr, ((o * length + p) * inner + i).cast("int")))
        summed = total(parts)
        return (summed / length if how == "mean" else summed).cast("float")

    return bind(_col(c), lambda arr: F.transform(
        F.sequence(F.lit(0), (outer * inner - 1).cast("int")), lambda k: cell(arr, k)))


def axis_mask(observed, target: int | None, centred: bool = False) -> Column:
    """TRUE where a cropped or padded axis holds a position that was really observed."""
    observed = F.lit(observed) if isinstance(observed, int) else observed
    size = observed if target is None else F.lit(target)
    keep = F.least(observed, size)
    start = F.when(size > observed, F.floor((size - keep) / 2)).otherwise(F.lit(0)) \
        if centred else F.lit(0)
    return F.transform(F.sequence(F.lit(0), (size - 1).cast("int")),
                       lambda k: (k >= start) & (k < start + keep))


def fit_coordinate(c, target: int, centred: bool = False) -> Column:
    """Crop a coordinate array, or pad it with -1, the way its axis is cropped or padded."""
    def fitted(arr: Column) -> Column:
        shift = F.lit(0)
        if centred:
            shift = F.when(F.size(arr) > target, F.floor((F.size(arr) - target) / 2)).otherwise(
                -F.floor((F.lit(target) - F.size(arr)) / 2))
        return F.transform(F.sequence(F.lit(0), F.lit(target - 1)), lambda k: F.when(
            (k + shift >= 0) & (k + shift < F.size(arr)), F.get(arr, (k + shift).cast("int"))
        ).otherwise(F.lit(-1)))

    return bind(_col(c), fitted)
