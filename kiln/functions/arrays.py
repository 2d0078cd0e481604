"""Array scalar functions (X15-X26) as ``Column -> Column`` expressions.

Arrays stay inside the row: higher-order functions (``transform``,
``zip_with``, ``aggregate``) run in the JVM with no shuffle and no Python.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORE_INDEX = -100  # fixed value: label for positions a loss must skip


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the
    body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lit_array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def prefix_standardise(arr: Column | str, mu: Column, sd: Column, d: int) -> Column:
    """Z-score the first ``d`` elements with arrays ``mu``/``sd`` (length
    d), pass the rest through unchanged."""
    a = _c(arr).cast("array<double>")
    head = F.zip_with(F.zip_with(F.slice(a, 1, d), mu, lambda x, m: x - m), sd,
                      lambda x, s: x / s)
    rest = F.when(F.size(a) > d, F.slice(a, d + 1, F.size(a) - d)) \
        .otherwise(F.array().cast("array<double>"))
    return F.concat(head, rest)


def scale_array(arr: Column | str, factor: float) -> Column:
    """Multiply every element by a constant (e.g. 1/255)."""
    return F.transform(_c(arr), lambda v: v * F.lit(factor))


def softmax(arr: Column | str, temperature: float = 1.0) -> Column:
    """``softmax(x / T)``, shifted by the maximum for stability. The
    maximum, the exponentials and their sum are bound once per row: inside a
    lambda they would be computed anew for every element."""
    def shifted(a: Column) -> Column:
        return once(F.array_max(a), lambda m: F.transform(a, lambda v: F.exp((v - m) / F.lit(temperature))))

    def shares(e: Column) -> Column:
        return once(F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v), lambda s: F.transform(e, lambda v: v / s))

    return once(once(_c(arr).cast("array<double>"), shifted), shares)


def argmax(arr: Column | str) -> Column:
    """0-based position of the first maximum (NumPy ``argmax``)."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def sample_category(logits: Column | str, row_key: Column, seed: int,
                    temperature: float = 1.0) -> Column:
    """Draw a category with probabilities ``softmax(logits / T)`` by the
    Gumbel-max rule. The uniform for element i of a row comes from the md5 of
    ``seed:row_key:i`` (32 bits), so a draw is reproducible under any
    partitioning and on any engine with md5."""
    a = _c(logits).cast("array<double>")

    def gumbel(v, i):
        key = F.concat_ws(":", F.lit(str(seed)), row_key.cast("string"), i.cast("string"))
        h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
        u = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
        return v / F.lit(float(temperature)) - F.log(-F.log(u))

    return argmax(F.transform(a, gumbel))


def squared_distance(a: Column | str, b: Column | str) -> Column:
    """Sum of squared element differences."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda acc, v: acc + v)


def shift_left(arr: Column | str, sentinel: int = IGNORE_INDEX) -> Column:
    """Drop the first element, append ``sentinel`` (``x[1:] + [s]``)."""
    a = _c(arr)
    n = F.size(a)
    a = a.cast("array<bigint>")
    tail = F.when(n > 1, F.slice(a, 2, n - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.concat(tail, F.array(F.lit(sentinel).cast("bigint")))


def pad_to(arr: Column | str, length: int, pad: Column | int) -> Column:
    """Right-pad with ``pad`` up to ``length`` (longer arrays unchanged)."""
    a = _c(arr)
    p = pad if isinstance(pad, Column) else F.lit(pad)
    return F.concat(a, F.array_repeat(p, F.greatest(F.lit(length) - F.size(a), F.lit(0))))


def attention_mask(arr: Column | str, length: int) -> Column:
    """1 for real positions, 0 for padding, as tinyint."""
    n = F.size(_c(arr))
    return F.concat(F.array_repeat(F.lit(1).cast("tinyint"), n),
                    F.array_repeat(F.lit(0).cast("tinyint"),
                                   F.greatest(F.lit(length) - n, F.lit(0))))


def chunk_starts(n_tokens: Column, budget: Column, overlap: int) -> Column:
    """Start offsets of overlapping windows of ``budget`` tokens that step
    by ``budget - overlap``; the last window is the first one reaching the end.
    Null when the budget does not exceed the overlap (the row is rejected)."""
    step = budget - F.lit(overlap)
    last = F.greatest(F.ceil((n_tokens - budget) / step), F.lit(0)) * step
    return F.when(step > 0, F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"),
                                       step.cast("bigint")))


def get_with_default(m: Column | str, key: Column | str, default) -> Column:
    """Map lookup with a default for a missing key."""
    return F.coalesce(F.try_element_at(_c(m), _c(key)), F.lit(default))
