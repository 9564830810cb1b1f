"""The warehouse as a set of DataFrames the rules read."""

from __future__ import annotations

import functools
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Warehouse:
    """Dimensions, validity-dated history tables and the transaction fact.

    ``terminals`` and ``passport_blacklist`` hold full history (effective_from,
    effective_to, deleted_flg); the rules take the rows valid at ``as_of``.
    """

    cards: DataFrame
    accounts: DataFrame
    clients: DataFrame
    terminals: DataFrame
    passport_blacklist: DataFrame
    transactions: DataFrame

    def with_(self, **changes: DataFrame) -> "Warehouse":
        return replace(self, **changes)

    @functools.cached_property
    def owners(self) -> DataFrame:
        """The card-level owner dimension, planned once per warehouse (a lazy
        plan, no data is cached)."""
        from fraudmart.operators.chain import owner_dim
        return owner_dim(self)
