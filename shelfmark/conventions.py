"""Business vocabulary a deployment may have to change."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Conventions:
    # Channel, identity, plan and label vocabulary.
    store_channel: str = "STORE"
    online_channels: tuple[str, ...] = ("WEB_A", "WEB_B")
    excluded_store_sales_type: int = 3
    normal_order_type: str = "normal"
    known_identity_types: tuple[str, ...] = ("CRM", "DY", "TM")
    plan_channel_like: str = "%STORE%"
    plan_version: str = "DP03"
    registration_like: str = "%STORE%"
    starred_line_like: str = "%Brand#1%"
    total_label: str = "TTL"

    @property
    def all_channels(self) -> tuple[str, ...]:
        return (self.store_channel, *self.online_channels)
