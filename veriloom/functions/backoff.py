"""Retry delays as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: delay multipliers by error type
ERROR_MULTIPLIERS = {
    "network_timeout": 0.5, "rate_limit": 2.0, "resource_exhausted": 3.0,
    "data_corruption": 5.0, "unknown": 1.0,
}
# fixed values: quick schedule for network errors, in seconds
NETWORK_SCHEDULE = (2, 4, 8, 16)
# fixed values: texts that mark a network error
NETWORK_MARKERS = (
    "timeout", "connection", "network", "socket", "unreachable", "reset by peer", "broken pipe",
    "connection refused", "no route to host", "temporary failure", "name resolution", "getaddrinfo failed",
)


def exponential(retry_count: Column, initial: float = 60, base: float = 2, cap: float = 3600,
                jitter: float = 0.0, key: Column | None = None) -> Column:
    """min(initial * base^retries, cap), spread by +-jitter.

    The spread is taken from a hash of ``key`` and the attempt, so a rerun gives the same delay.
    """
    tries = F.greatest(retry_count, F.lit(0)).cast("double")
    delay = F.least(F.lit(float(initial)) * F.pow(F.lit(float(base)), tries), F.lit(float(cap)))
    if jitter <= 0:
        return delay
    if key is None:
        raise ValueError("jitter needs a key column")
    unit = F.pmod(F.xxhash64(key, retry_count), F.lit(1_000_003)) / F.lit(1_000_002.0)
    return delay * (F.lit(1 - jitter) + F.lit(2 * jitter) * unit)


def adaptive(retry_count: Column, error_type: Column, load: Column, initial: float = 60, base: float = 2,
             cap: float = 3600, jitter: float = 0.0, key: Column | None = None) -> Column:
    """Exponential delay scaled by error type and system load; unknown types scale by 1, NULLs not at all."""
    table = F.create_map(*[F.lit(x) for pair in ERROR_MULTIPLIERS.items() for x in pair])
    factor = F.coalesce(F.try_element_at(table, error_type), F.lit(1.0))
    delay = exponential(retry_count, initial, base, cap, jitter, key)
    return F.least(delay * factor * (F.lit(1.0) + F.coalesce(load, F.lit(0.0))), F.lit(float(cap)))


def network(retry_count: Column, schedule=NETWORK_SCHEDULE) -> Column:
    """The scheduled delay; the last one repeats."""
    steps = F.array(*[F.lit(float(s)) for s in schedule])
    return F.element_at(steps, F.least(retry_count + 1, F.lit(len(schedule))).cast("int"))


def network_retryable(retry_count: Column, schedule=NETWORK_SCHEDULE) -> Column:
    return retry_count < F.lit(len(schedule))


def is_network_error(message: Column) -> Column:
    return F.coalesce(F.lower(message).rlike("|".join(NETWORK_MARKERS)), F.lit(False))


def delay_for(strategy: str, retry_count: Column, error_type: Column | None = None, load: Column | None = None,
              **options) -> Column:
    """Choose a strategy by name: exponential, adaptive or network."""
    if strategy == "network":
        return network(retry_count)
    if strategy == "adaptive":
        return adaptive(retry_count, error_type if error_type is not None else F.lit(None).cast("string"),
                        load if load is not None else F.lit(None).cast("double"), **options)
    if strategy == "exponential":
        return exponential(retry_count, **options)
    raise ValueError(f"unknown strategy {strategy}")
