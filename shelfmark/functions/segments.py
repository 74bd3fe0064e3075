"""Scalar segment rules for products, members and counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from shelfmark.functions.windows import date_literal

NOVELTY, EXISTING = "novelty", "existing"

# Age-mark patterns. Marks read "1 1/2", "6+", "9-12"; a whole number with a
# fraction is recognised first, otherwise the leading digits count.
FRACTION_MARK = "^([0-9]+) ([0-9]+)/([0-9]+)"
LEADING_NUMBER = "^[0-9]+"

# Fixed values: (label, lowest, highest) in years.
AGE_BANDS = (
    ("0-5", None, 5),
    ("6-8", 6, 8),
    ("9-12", 9, 12),
    ("13-17", 13, 17),
    ("18+", 18, None),
)
MEMBER_AGE_BANDS = (
    ("<18", None, 17),
    ("18-25", 18, 25),
    ("26-30", 26, 30),
    ("31-35", 31, 35),
    ("36-40", 36, 40),
    ("41-45", 41, 45),
    ("46-50", 46, 50),
    ("51-55", 51, 55),
    ("56+", 56, None),
)
MEMBER_AGE_UNKNOWN = "age_unknown"
GENDER_LABELS = ((1, "male"), (2, "female"), (0, "gender_unknown"))
CITY_TIER_UNKNOWN = "unspecified"
CITY_MATURITY_UNKNOWN = "4_unspecified"


def text_list(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def canonical_member_id(type_name: str, type_value: str, bridge_id: str, known: Sequence[str]) -> str:
    """The member's own id, else the channel's id for it; NULL for unknown identity types."""
    return (
        f"CASE WHEN {type_name} IN ({text_list(known)}) "
        f"THEN coalesce(CAST({bridge_id} AS STRING), CAST({type_value} AS STRING)) END"
    )


def is_rated(age_mark: str) -> str:
    return f"trim({age_mark}) RLIKE '{LEADING_NUMBER}'"


def min_age(age_mark: str) -> str:
    """Youngest age in whole years. The fraction is divided as integers, so "1 1/2" is 1;
    a mark that holds no number gives 0."""
    mark = f"trim({age_mark})"

    def part(i: int) -> str:
        return f"try_cast(regexp_extract({mark}, '{FRACTION_MARK}', {i}) AS INT)"

    return (
        f"CAST(coalesce(CASE WHEN {mark} RLIKE '{FRACTION_MARK}' "
        f"THEN {part(1)} + {part(2)} div nullif({part(3)}, 0) "
        f"ELSE try_cast(regexp_extract({mark}, '{LEADING_NUMBER}', 0) AS INT) END, 0) AS INT)"
    )


def band(value: str, bands) -> str:
    """CASE over inclusive ranges; NULL and uncovered values give NULL."""
    rules = []
    for label, low, high in bands:
        tests = [f"{value} >= {low}"] if low is not None else []
        tests += [f"{value} <= {high}"] if high is not None else []
        rules.append(f"WHEN {' AND '.join(tests)} THEN '{label}'")
    return f"CASE {' '.join(rules)} END"


def age_band(years: str) -> str:
    return band(years, AGE_BANDS)


def audience_segment(years: str) -> str:
    """13-17, 18+ and everything else, products without a rating included."""
    return (
        f"CASE WHEN {years} >= 13 AND {years} <= 17 THEN 'adult_13_to_17' "
        f"WHEN {years} >= 18 THEN 'adult_18_plus' ELSE 'kids' END"
    )


def price_band(price: str, include_zero: bool = False, low: int = 300, high: int = 800) -> str:
    positive = f"{price} >= 0" if include_zero else f"{price} > 0"
    return (
        f"CASE WHEN {positive} AND {price} < {low} THEN 'LPP' "
        f"WHEN {price} >= {low} AND {price} < {high} THEN 'MPP' WHEN {price} >= {high} THEN 'HPP' END"
    )


def novelty_since(launch: str, cutoff: dt.date) -> str:
    return f"CASE WHEN {launch} >= {date_literal(cutoff)} THEN '{NOVELTY}' ELSE '{EXISTING}' END"


def novelty_in_year(launch: str, year: int) -> str:
    return f"CASE WHEN year({launch}) = {year} THEN '{NOVELTY}' ELSE '{EXISTING}' END"


def fill_city_tier(tier: str) -> str:
    return f"coalesce({tier}, '{CITY_TIER_UNKNOWN}')"


def fill_city_maturity(maturity: str) -> str:
    return f"coalesce({maturity}, '{CITY_MATURITY_UNKNOWN}')"


def gender_label(code: str) -> str:
    return f"CASE {' '.join(f'WHEN {code} = {v} THEN {label!r}' for v, label in GENDER_LABELS)} END"


def member_age_band(birthday: str, profile_year: int) -> str:
    years = f"({profile_year} - year({birthday}))"
    return f"coalesce({band(years, MEMBER_AGE_BANDS)}, '{MEMBER_AGE_UNKNOWN}')"


def gap_bucket(days: str, width: int = 50, top: int = 1000) -> str:
    """``<50``, ``50-100``, ... ``950-1000``, ``1000+``."""
    low = f"({days} div {width}) * {width}"
    return (
        f"CASE WHEN {days} < {width} THEN '<{width}' WHEN {days} >= {top} THEN '{top}+' "
        f"ELSE concat({low}, '-', {low} + {width}) END"
    )


def capped_count_label(count: str, cap: int) -> str:
    """The count as text, ``cap+`` from the cap on."""
    return f"CASE WHEN {count} >= {cap} THEN '{cap}+' ELSE CAST(CAST({count} AS BIGINT) AS STRING) END"


def line_split(line: str, sku_name: str, target: str, keyword: str) -> str:
    """Divide one product line by a keyword in the SKU name; without a name its SKUs have no line."""
    inside = f"{sku_name} LIKE '%{keyword}%'"
    divided = f"CASE WHEN {inside} THEN '{target}_WITH' WHEN NOT {inside} THEN '{target}_WITHOUT' END"
    return f"IF({line} = '{target}', {divided}, {line})"
