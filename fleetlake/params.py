"""Job parameters.

The reference hard-codes buyer groups, buyer user ids, responsible persons,
warehouse codes, branch patterns and the clock. Here they are parameters of
a frozen dataclass so that no job reads the clock or personal ids itself.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # reference date that replaces CURRENT_DATE / the current year
    as_of: dt.date = field(default_factory=dt.date.today)
    # owner filter of the purchasing jobs (PF-5)
    buyer_groups: tuple[str, ...] = ()
    buyer_users: tuple[str, ...] = ()
    # responsible persons of the external work orders (stripped ids)
    responsibles: tuple[str, ...] = ()
    # lower bound of order creation dates for order-based jobs
    orders_since: dt.date = dt.date(2024, 1, 1)
    # branch work-centre codes (substring match) of the yard jobs
    branch_codes: tuple[str, ...] = ()
    # branch name substrings of the yard event feed
    yard_branches: tuple[str, ...] = ()
    # windowed backfill: requisition flow
    rc_total_days: int = 180
    rc_step_days: int = 14
    # windowed backfill: purchase history
    hist_total_days: int = 1095
    hist_step_days: int = 30
    # first year of the half-year periods of the parts history
    parts_first_year: int = 2024
    # reservations: storage locations, movement types, stock warehouse
    storage_locations: tuple[str, ...] = ()
    movement_types: tuple[str, ...] = ("201", "261")
    stock_warehouse: str = ""
    # languages of material / equipment text tables
    text_langs: tuple[str, ...] = ("P", "PT")
    # S-9 / PF-16 / PF-18: date texts compared as dates ('date') or as raw text ('text')
    date_mode: str = "date"
    # S-8: Spark collation under which asset codes and report types of the yard and meter feeds are equal,
    # as a MySQL collation may make them ("UTF8_LCASE_RTRIM", "UNICODE_CI_AI_RTRIM"); None compares bytes
    collation: str | None = None
    # S-14: newest reports per upper-trimmed code instead of per raw code
    group_normalised: bool = False
    # S-2: newest approval by date, then hours; otherwise hours first, as the reference sorts
    approvals_date_first: bool = False
    # S-11: 'collapse' gives one text per key, 'keep' one row per text, as plain joins on the text tables do
    fanout: str = "collapse"

    def need(self, *names: str) -> None:
        """Raise unless every named parameter is set: an empty owner, branch or warehouse list would
        deliver an empty result that reads as "everything is gone"."""
        for name in names:
            if not getattr(self, name):
                raise ValueError(f"parameter {name!r} is not set")

    def need_owner(self) -> None:
        if not (self.buyer_groups or self.buyer_users):
            raise ValueError("parameters 'buyer_groups' and 'buyer_users' are both not set")
