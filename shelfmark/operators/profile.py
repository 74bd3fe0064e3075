"""Member profiles: children, age, gender."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.calendar import ReportCalendar
from shelfmark.functions import segments
from shelfmark.sources.tables import Warehouse

# Fixed values: (suffix, youngest, oldest) of a child in years.
KID_AGES = (
    ("0_to_5", None, 5),
    ("6_to_8", 6, 8),
    ("9_to_12", 9, 12),
    ("13_to_17", 13, 17),
    ("18_plus", 18, None),
)
KID_PERSON_TYPE = 2
# Fixed values: (column suffix, label tested). The youngest label is tested with a blank that
# the age bands do not write, so that column stays empty unless ``fix_under_18`` is set.
AGE_COLUMNS = (
    ("less_than_18", "< 18"),
    ("18_to_25", "18-25"),
    ("26_to_30", "26-30"),
    ("31_to_35", "31-35"),
    ("36_to_40", "36-40"),
    ("41_to_45", "41-45"),
    ("46_to_50", "46-50"),
    ("51_to_55", "51-55"),
    ("56_plus", "56+"),
    ("unknown", "age_unknown"),
)
MATURITY_COLUMNS = ("1_mature", "2_core", "3_uprising", "4_unspecified")
TIER_COLUMNS = (*[(str(i), f"Tier {i}") for i in range(1, 7)], ("unspecified", "unspecified"))
GENDER_COLUMNS = (("male", "male"), ("female", "female"), ("unknown", "gender_unknown"))


def kid_age_flags(history: DataFrame, cal: ReportCalendar) -> DataFrame:
    """Per member with a child on record: one 0/1 flag per age band, over all children."""
    age = f"({cal.profile_year} - birthday_year)"
    flags = []
    for suffix, low, high in KID_AGES:
        tests = [f"{age} >= {low}"] if low is not None else []
        tests += [f"{age} <= {high}"] if high is not None else []
        flags.append(f"max(CASE WHEN {' AND '.join(tests)} THEN 1 ELSE 0 END) AS has_kid_{suffix}")
    return (
        history.filter(f"person_type = {KID_PERSON_TYPE}")
        .groupBy("member_detail_id")
        .agg(*map(F.expr, flags))
    )


def member_profile(wh: Warehouse, cal: ReportCalendar) -> DataFrame:
    """Distinct profile rows keyed on ``member_key`` (the member id as a number)."""
    kids = kid_age_flags(
        wh.table("birthday_history", ["member_detail_id", "birthday_year", "person_type"]), cal
    ).withColumnRenamed("member_detail_id", "kid_member")
    members = wh.table(
        "member",
        ["member_detail_id", "tier_code", "gender", "birthday", "beneficiary_birthday", "has_kid"],
    )
    same = "try_cast(member_detail_id AS BIGINT) = try_cast(kid_member AS BIGINT)"
    flags = [f"has_kid_{suffix}" for suffix, _, _ in KID_AGES]
    return (
        members.join(kids, F.expr(same), "left")
        .selectExpr(
            "try_cast(member_detail_id AS BIGINT) AS member_key",
            "tier_code",
            f"{segments.gender_label('gender')} AS gender_label",
            f"{segments.member_age_band('birthday', cal.profile_year)} AS age_group",
            "CASE WHEN beneficiary_birthday IS NULL THEN 0 ELSE 1 END AS has_birthday",
            "CASE WHEN kid_member IS NOT NULL OR has_kid = 1 THEN 1 ELSE 0 END AS has_kid",
            *flags,
        )
        .distinct()
    )


PROFILE_LINE_COLUMNS = (
    "has_kid",
    *[f"has_kid_{suffix}" for suffix, _, _ in KID_AGES],
    "city_maturity",
    "city_tier",
    "age_group",
    "gender_label",
)


def profile_counts(fix_under_18: bool = False) -> dict[str, tuple[str, str]]:
    """The 30 profile columns as distinct member counts: name -> (counted, condition)."""
    tests = {"has_kid": "has_kid = 1"}
    tests |= {f"has_kid_{suffix}": f"has_kid_{suffix} = 1" for suffix, _, _ in KID_AGES}
    tests |= {f"city_maturity_type_{m}": f"city_maturity = '{m}'" for m in MATURITY_COLUMNS}
    tests |= {f"city_tier_{n}": f"city_tier = '{label}'" for n, label in TIER_COLUMNS}
    for n, label in AGE_COLUMNS:
        label = "<18" if fix_under_18 and n == "less_than_18" else label
        tests[f"age_{n}"] = f"age_group = '{label}'"
    tests |= {f"gender_{n}": f"gender_label = '{label}'" for n, label in GENDER_COLUMNS}
    return {
        f"member_shopper_profile_{name}": ("member_detail_id", f"valid AND {test}")
        for name, test in tests.items()
    }


def latest_attribute_segment(events: DataFrame, key: str, value: str, id_key: str) -> DataFrame:
    """Profiles whose newest event of ``key`` has ``value``, with the newest ``id_key`` value.

    The newest event is a maximum, combined map-side; equal times go to the later event id.
    """
    newest = "max_by(prop_value, struct(update_time, event_id))"
    latest = (
        events.filter(F.col("prop_key").isin(key, id_key))
        .groupBy("profile_id")
        .agg(
            F.expr(f"{newest} FILTER (WHERE prop_key = '{key}') AS segment_value"),
            F.expr(f"{newest} FILTER (WHERE prop_key = '{id_key}') AS member_ref"),
            F.expr(f"count_if(prop_key = '{id_key}') AS id_events"),
        )
    )
    return latest.filter(F.expr(f"segment_value = '{value}' AND id_events > 0")).select(
        "profile_id", "member_ref"
    )
