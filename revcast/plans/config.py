"""Parameters of the forecast pipelines (defaults: the original's values)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from .. import constants as K


@dataclass(frozen=True)
class ForecastConfig:
    # Point in time that replaces the database clock (recognised vs
    # deferred, effective-dated reps). A timestamp, as the database's
    # clock carried a time of day. UTC, as the session's time zone.
    as_of: str = field(default_factory=lambda: _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))
    last_legacy_period: int = K.LAST_LEGACY_PERIOD
    first_new_period: int = K.FIRST_NEW_PERIOD
    excluded_fiscal_years: tuple[str, ...] = K.EXCLUDED_FISCAL_YEARS
    test_accounts: tuple[str, ...] = K.TEST_ACCOUNTS
    billing_min_period: int = K.BILLING_MIN_PERIOD
    ledger_min_period: int = K.LEDGER_MIN_PERIOD
    ledger_max_period: int = K.LEDGER_MAX_PERIOD
    contract_min_period: int = K.LEDGER_MIN_PERIOD
    contract_max_period: int = K.LEDGER_MAX_PERIOD
    ledger_segment1: str = K.LEDGER_SEGMENT1
    ledger_segment2: str = K.LEDGER_SEGMENT2
    billing_sources: tuple[str, ...] = K.BILLING_SOURCES
    contract_sources: tuple[str, ...] = K.CONTRACT_SOURCES
    billing_excluded_products: tuple[str, ...] = K.BILLING_EXCLUDED_PRODUCTS
    billing_excluded_accounting_rules: tuple[str, ...] = K.BILLING_EXCLUDED_ACCOUNTING_RULES
    billing_excluded_resources: tuple[int, ...] = ()
    contract_excluded_products: tuple[str, ...] = K.CONTRACT_EXCLUDED_PRODUCTS
    contract_excluded_resources: tuple[int, ...] = ()
    pro_forma_prefix: str = K.PRO_FORMA_PREFIX
    hold_name: str = K.HOLD_NAME
    hold_organization_id: int = K.HOLD_ORGANIZATION_ID
    rep_group_prefix: str = K.REP_GROUP_PREFIX
    excluded_salesreps: tuple[int, ...] = ()
    opportunity_overrides: dict = field(default_factory=lambda: dict(K.OPPORTUNITY_ID_OVERRIDES))
    # Above this many bytes (optimizer estimate) a side marked as a bounded
    # dimension is joined by shuffle instead of broadcast.
    broadcast_ceiling: int = 64 * 1024 * 1024
    # Part of a fact whose keys are sketched for hot values before the order
    # chain runs, where its right tables are too large to broadcast; 0: none.
    profile_fraction: float = 0.01

    @property
    def as_of_date(self) -> _dt.date:
        return _dt.date.fromisoformat(self.as_of[:10])


def driver_config() -> ForecastConfig:
    """Parameters fitted to the driver tables (dates 1995-2001), so that
    every branch of every rule is reached."""
    return ForecastConfig(
        as_of="1999-06-30 12:00:00",
        last_legacy_period=199812,
        first_new_period=199901,
        excluded_fiscal_years=("FY95", "FY96"),
        test_accounts=("Customer#000000007", "Customer#000000011"),
        billing_min_period=199601,
        ledger_min_period=199601,
        ledger_max_period=200106,
        contract_min_period=199601,
        contract_max_period=200112,
        billing_excluded_products=("Brand#1",),
        billing_excluded_resources=(3,),
        contract_excluded_products=("Brand#2", "Brand#3"),
        contract_excluded_resources=(3, 5),
        excluded_salesreps=(4,),
        opportunity_overrides={"OP-10": "OP-11"},
    )


# Zero-out rules for the driver tables (party, day) and (order).
DRIVER_ZERO_PARTY_DATES = ((1, "1996-01-02"), (10, "1998-03-07"), (100, "1997-05-20"))
DRIVER_ZERO_ORDERS = (3, 5, 32, 100)
