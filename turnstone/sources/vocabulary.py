"""Stage vocabularies and theme taxonomies from YAML, validated and broadcast-sized."""

from __future__ import annotations

from collections import Counter

import yaml
from pyspark.sql import DataFrame, SparkSession

#: The stages of a bill, in order.
STAGES = ("introduction", "first_reading", "second_reading", "referral", "committee", "recommittal", "report", "third_reading", "passed", "returned", "messages", "conference", "final_stages", "assent")
#: The taxonomy's locale by jurisdiction.
LOCALES = {"wa": "en-AU", "sa": "en-AU", "nsw": "en-AU", "au": "en-AU", "nz": "en-NZ", "scot": "en-GB"}


#: The names under which parliaments publish the stages of a bill.
PUBLISHED = {
    "wa": """
first_reading: [Introduction and first reading, Receipt and first reading]
second_reading: [Second reading, Second reading speech]
committee: [Consideration in detail, Committee of the whole]
report: [Report]
third_reading: [Third reading]
returned: [Returned]
assent: [Assent]
""",
    "sa": """
introduction: [Introduction]
first_reading: [First Reading, Introduction and First Reading]
second_reading: [Second Reading]
referral: [Referred to Select Committee]
committee: [Committee Stage]
recommittal: [Recommittal]
third_reading: [Third Reading]
conference: [Conference]
final_stages: [Final Stages]
assent: [Assent]
""",
    "nsw": """
first_reading: [First Reading]
second_reading: [Second Reading, Second Reading Speech, Second Reading Debate, Agreement in Principle]
committee: [In Committee, Consideration in Detail]
report: [Report, Adoption of Report]
third_reading: [Third Reading]
passed: [Passing of the Bill]
returned: [Returned]
assent: [Assent]
""",
    "au": """
first_reading: [First Reading]
second_reading: [Second Reading]
referral: [Reference to Federation Chamber]
committee: [In Committee, Consideration in Detail, Consideration]
report: [Report, Report from Federation Chamber]
third_reading: [Third Reading]
returned: [Returned from Senate, Returned from the House of Representatives]
messages: [Consideration of Senate Message]
assent: [Assent]
""",
}


def stage_rows(jurisdiction: str, text: str) -> list[tuple[str, str, str, int]]:
    """(jurisdiction, name_lower, stage, stage_order) of a YAML mapping of stages to names.

    All faults of the mapping, unknown stages and names listed twice, are
    reported together.
    """
    mapping = yaml.safe_load(text) or {}
    order = dict(zip(STAGES, range(len(STAGES)), strict=True))
    pairs = [(" ".join(name.lower().split()), stage) for stage in mapping for name in mapping[stage] or ()]
    times = Counter(name for name, _ in pairs)
    faults = [f"unknown stage {stage!r}" for stage in sorted(mapping.keys() - order.keys())] + [f"{name!r} is listed {n} times" for name, n in times.items() if n > 1]
    if faults:
        raise ValueError("; ".join(faults))
    return [(jurisdiction, name, stage, order[stage]) for name, stage in pairs]


def stage_table(spark: SparkSession, files: dict[str, str] = PUBLISHED) -> DataFrame:
    """The vocabulary of several jurisdictions; *files* maps each to its YAML text."""
    rows = [r for jurisdiction, text in files.items() for r in stage_rows(jurisdiction, text)]
    return spark.createDataFrame(rows, "jurisdiction string, name_lower string, stage string, stage_order int")


def taxonomy(spark: SparkSession, text: str) -> DataFrame:
    """(locale, version, theme_id, theme_name, description, procedural) of one taxonomy."""
    data = yaml.safe_load(text)
    ids = [t["id"] for t in data["themes"]]
    if len(set(ids)) != len(ids):
        raise ValueError("a theme id is listed twice")
    rows = [(data["locale"], int(data["version"]), t["id"], t["name"], t.get("description", ""), bool(t.get("procedural", False))) for t in data["themes"]]
    return spark.createDataFrame(rows, "locale string, version int, theme_id string, theme_name string, description string, procedural boolean")


def locale_of(jurisdiction: str) -> str:
    return LOCALES.get(jurisdiction, "en-AU")
