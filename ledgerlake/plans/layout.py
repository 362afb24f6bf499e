"""Where the layers of one lake are."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LakePaths:
    raw: str
    fx: str
    bronze: str
    silver: str
    gold: str
    reject: str

    @classmethod
    def under(cls, root: str) -> LakePaths:
        root = root.rstrip("/")
        return cls(
            raw=f"{root}/transactions",
            fx=f"{root}/exchange_rates",
            bronze=f"{root}/bronze/transactions",
            silver=f"{root}/silver/transactions",
            gold=f"{root}/gold/transactions_sgd",
            reject=f"{root}/reject/transactions",
        )

    @property
    def fx_reject(self) -> str:
        return f"{self.reject}_rates"

    @property
    def gold_reject(self) -> str:
        return f"{self.reject}_gold"

    @property
    def currency_agg(self) -> str:
        return f"{self.silver}/currency_agg"

    @property
    def detail(self) -> str:
        return f"{self.silver}/detail"


@dataclass(frozen=True)
class WarehousePaths:
    curated: str
    staging: str
    ods: str
    dimension: str
    fact: str

    @classmethod
    def under(cls, root: str) -> WarehousePaths:
        root = root.rstrip("/")
        names = ("curated", "staging", "ods", "dimension", "fact")
        return cls(**{name: f"{root}/{name}" for name in names})

    @property
    def staged_days(self) -> str:
        return f"{self.staging}_days"

    @property
    def state_buckets(self) -> str:
        return f"{self.ods}_buckets"

    @property
    def timeline_buckets(self) -> str:
        return f"{self.dimension}_buckets"

    @property
    def published(self) -> str:
        return f"{self.ods}_published"

    @property
    def change_reject(self) -> str:
        return f"{self.curated}_rejects"

    @property
    def fact_reject(self) -> str:
        return f"{self.fact}_rejects"
