"""Retry policies as column expressions.

A policy maps the status of a put (retries so far, nanoseconds waited so far) to the nanoseconds to
wait before the next attempt, or to null: give up. Delays saturate at the largest bigint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONGEST = (1 << 63) - 1

Decide = Callable[[Column, Column], Column]


def _ns(value: int) -> Column:
    return F.lit(value).cast("bigint")


class Policy:
    """A retry policy and its combinators."""

    def __init__(self, decide: Decide):
        self.decide = decide

    @staticmethod
    def from_expr(decide: Decide) -> "Policy":
        return Policy(decide)

    @staticmethod
    def always_give_up() -> "Policy":
        return Policy(lambda retries, waited: F.lit(None).cast("bigint"))

    @staticmethod
    def constant_delay(delay_ns: int) -> "Policy":
        return Policy(lambda retries, waited: _ns(delay_ns))

    @staticmethod
    def exponential_backoff(base_ns: int) -> "Policy":
        """base, 2 base, 4 base, ..."""
        shifts = 63 - base_ns.bit_length()
        table = F.array(*[_ns(base_ns << n) for n in range(shifts + 1)])
        beyond = LONGEST if base_ns else 0
        return Policy(lambda retries, waited: F.coalesce(F.get(table, retries), _ns(beyond)))

    @staticmethod
    def fibonacci_backoff(base_ns: int) -> "Policy":
        """base, base, 2 base, 3 base, 5 base, ..."""
        delays, a, b = [], 1, 1
        while a * base_ns < LONGEST and len(delays) < 92:
            delays.append(a * base_ns)
            a, b = b, a + b
        table = F.array(*[_ns(d) for d in delays]) if delays else F.array(_ns(LONGEST))
        beyond = LONGEST if base_ns else 0
        return Policy(lambda retries, waited: F.coalesce(F.get(table, retries), _ns(beyond)))

    @staticmethod
    def full_jitter(base_ns: int, seed: int = 0, by: tuple[str, ...] = ("stream_name", "put_id")) -> "Policy":
        """Uniform in [0, exponential delay).

        The draw is a hash of the put, its retry count and the seed: all records of a put draw alike,
        and a task that is run again draws the same.
        """
        ceiling = Policy.exponential_backoff(base_ns)

        def decide(retries, waited):
            bits = F.shiftrightunsigned(F.xxhash64(*by, retries, F.lit(seed)), 11)
            draw = bits.cast("double") / float(1 << 53)
            return F.floor(ceiling.decide(retries, waited).cast("double") * draw).cast("bigint")

        return Policy(decide)

    @staticmethod
    def limit_retries(most: int) -> "Policy":
        return Policy(lambda retries, waited: F.when(retries < most, _ns(0)))

    def cap_delay(self, cap_ns: int) -> "Policy":
        """Bound each delay. A meet with a constant delay, so the result never gives up."""
        return self.meet(Policy.constant_delay(cap_ns))

    def limit_by_delay(self, threshold_ns: int) -> "Policy":
        def decide(retries, waited):
            delay = self.decide(retries, waited)
            return F.when(delay <= threshold_ns, delay)

        return Policy(decide)

    def limit_by_cumulative_delay(self, threshold_ns: int) -> "Policy":
        def decide(retries, waited):
            delay = self.decide(retries, waited)
            return F.when(waited < _ns(threshold_ns) - delay, delay)

        return Policy(decide)

    def join(self, other: "Policy") -> "Policy":
        """Retry only if both would, after the longer delay."""

        def decide(retries, waited):
            a, b = self.decide(retries, waited), other.decide(retries, waited)
            return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))

        return Policy(decide)

    def meet(self, other: "Policy") -> "Policy":
        """Retry if either would, after the shorter delay."""
        return Policy(lambda retries, waited: F.least(self.decide(retries, waited), other.decide(retries, waited)))

    def followed_by(self, other: "Policy") -> "Policy":
        return Policy(lambda retries, waited: F.coalesce(self.decide(retries, waited), other.decide(retries, waited)))

    def map_delay(self, change: Callable[[Column], Column]) -> "Policy":
        def decide(retries, waited):
            delay = self.decide(retries, waited)
            return F.when(delay.isNotNull(), change(delay))

        return Policy(decide)


def plan_retries(failed: DataFrame, policy: Policy) -> DataFrame:
    """Decide per failed record from its ``retries_so_far`` and ``cumulative_ns``.

    Adds ``decision`` ('retry' or 'give_up'), ``delay_ns`` (null when giving up) and the status after
    the decision, ``next_retries`` and ``next_cumulative_ns``.
    """
    delay = policy.decide(F.col("retries_so_far"), F.col("cumulative_ns"))
    decided = failed.withColumn("delay_ns", delay)
    waited, pause = F.col("cumulative_ns"), F.coalesce("delay_ns", _ns(0))
    return decided.withColumns(
        {
            "decision": F.when(F.col("delay_ns").isNull(), "give_up").otherwise("retry"),
            "next_retries": F.col("retries_so_far") + F.when(F.col("delay_ns").isNull(), 0).otherwise(1),
            "next_cumulative_ns": F.when(waited > _ns(LONGEST) - pause, _ns(LONGEST)).otherwise(waited + pause),
        }
    )
