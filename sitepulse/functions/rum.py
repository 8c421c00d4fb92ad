"""Real-user-metric functions: bin spreading and the share predicates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

GOOD_SHARE = 0.75
POOR_SHARE = 0.25


def spread(start: Column, end: Column, density: Column, width: Column, clamp: Column, dtype: str) -> Column:
    """Cut one bin ``[start, end)`` into equal steps and share its density between them.

    The end is clamped to ``start + clamp``. Returns ``array<struct<start, density>>``; an empty
    bin, or one without an end, gives an empty array. The edges stay in their own exact type.
    """
    lo = F.coalesce(start, F.lit(0)).cast(dtype)
    step = width.cast(dtype)
    hi = F.when(end.isNotNull(), F.least(end.cast(dtype), (lo + clamp.cast(dtype)).cast(dtype)))
    steps = (hi - lo).cast("double") / step.cast("double")
    # Rounded first: 0.07 / 0.01 is slightly above 7 in binary.
    n = F.ceil(F.round(steps, 6)).cast("int")
    share = density / steps
    return F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(
                (lo + i.cast(dtype) * step).cast(dtype).alias("start"),
                share.alias("density"),
            ),
        ),
    ).otherwise(F.array())


def client_of(form_factor: Column) -> Column:
    return F.when(form_factor == "desktop", F.lit("desktop")).otherwise(F.lit("mobile"))


def form_factor_of(client: Column) -> Column:
    return F.when(client == "desktop", F.lit("desktop")).otherwise(F.lit("phone"))


def device_of(client: Column) -> Column:
    return F.when(client == "mobile", F.lit("phone")).otherwise(client)


def is_good(good: Column, middling: Column, poor: Column) -> Column:
    return F.try_divide(good, good + middling + poor) >= F.lit(GOOD_SHARE)


def is_poor(good: Column, middling: Column, poor: Column) -> Column:
    return F.try_divide(poor, good + middling + poor) >= F.lit(POOR_SHARE)


def is_non_zero(good: Column, middling: Column, poor: Column) -> Column:
    return (good + middling + poor) > 0
