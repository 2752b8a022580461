"""Pluggable kernels with a cost, a speed and a quality, of which each row gets the best that it can have."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Provider:
    """A kernel, from a column to a column, and what is said of it; speed and quality are of ten."""

    name: str
    kernel: Callable[[Column], Column]
    cents: int
    speed: int
    quality: int


class Providers:
    """Providers by name, in the order in which they were registered."""

    def __init__(self, providers: Iterable[Provider] = ()):
        self._known: dict[str, Provider] = {}
        for p in providers:
            self.register(p)

    def register(self, provider: Provider) -> None:
        if provider.name in self._known:
            raise ValueError(f"{provider.name} is registered already")
        if not (0 <= provider.speed <= 10 and 0 <= provider.quality <= 10 and provider.cents >= 0):
            raise ValueError(f"{provider.name}: ratings are of ten, and costs not negative")
        self._known[provider.name] = provider

    def names(self) -> list[str]:
        return list(self._known)

    def get(self, name: str) -> Provider:
        if name not in self._known:
            raise ValueError(f"unknown provider {name}; known are {self.names()}")
        return self._known[name]

    def best(self, budget: Column, available: Column | None = None) -> Column:
        """Name of the provider of best quality, then speed, then cost, that costs at most `budget` cents; null if none does.

        available: an array of names; all are, where it is not given.
        """
        fits = []
        for place, p in enumerate(self._known.values()):
            can = F.lit(p.cents) <= budget
            if available is not None:
                can = can & F.array_contains(available, p.name)
            fits.append(F.when(can, F.struct(F.lit(-p.quality).alias("q"), F.lit(-p.speed).alias("s"), F.lit(p.cents).alias("c"), F.lit(place).alias("k"), F.lit(p.name).alias("name"))))
        return F.array_min(F.array_compact(F.array(*fits)))["name"]

    def run(self, df: DataFrame, provider: str, value: str, out: str, cost: str | None = None) -> DataFrame:
        """Add what each row's provider makes of `value`, and what that costs; null for a row without one.

        One expression with a branch for each provider, so a row runs its own kernel alone.
        """
        made, cents = F.lit(None), F.lit(None).cast("int")
        for name, p in self._known.items():
            made = F.when(F.col(provider) == name, p.kernel(F.col(value))).otherwise(made)
            cents = F.when(F.col(provider) == name, p.cents).otherwise(cents)
        return df.withColumns({out: made} | ({cost: cents} if cost else {}))
