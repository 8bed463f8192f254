"""Member registers: snapshots of current and former members to one row each."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstone.functions.columns import deterministic_id
from turnstone.operators.windows import top_n

from .tables import overwrite_partitions

COLUMNS = "source_member_id string, display_name string, title string, first_name string, other_names string, last_name string, date_of_birth date, house string, electorate string, party_name string, is_current boolean, deceased boolean, elected_date date, archived_date date"


def preferred(rows: DataFrame, keys: list[str], seen: str) -> DataFrame:
    """One row per key: current before former, then the greatest *seen*."""
    return top_n(rows, keys, [F.col("is_current").desc_nulls_last(), F.col(seen).desc_nulls_last()], 1)


def any_date(text: Column) -> Column:
    """A date written 2025-01-31, 31/01/2025 or Jan 31 2025; null for anything else."""
    iso = F.regexp_extract(text, r"^\s*(\d{4}-\d{2}-\d{2})", 1).try_cast("date")
    day = F.regexp_replace(F.regexp_extract(text, r"^\s*(\d{1,2}/\d{1,2}/\d{4})", 1), r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$2-$1").try_cast("date")
    words = F.regexp_extract(text, r"^\s*([A-Z][a-z]{2}\s+\d{1,2}\s+\d{4})", 1)
    named = F.try_to_timestamp(F.regexp_replace(words, r"\s+", " "), F.lit("MMM d yyyy")).cast("date")
    return F.coalesce(iso, day, named)


def from_json_snapshots(spark: SparkSession, paths: list[str], jurisdiction: str) -> DataFrame:
    """The register of JSON snapshots whose records carry the names of COLUMNS; dates in either shape."""
    schema = ", ".join(f"{c.split()[0]} {'boolean' if c.endswith('boolean') else 'string'}" for c in COLUMNS.split(", "))
    rows = spark.read.schema(schema).option("multiLine", True).json(paths)
    dates = [c.split()[0] for c in COLUMNS.split(", ") if c.endswith(" date")]
    rows = rows.withColumns({d: any_date(F.col(d)) for d in dates}).where("source_member_id is not null")
    one = preferred(rows, ["source_member_id"], "archived_date")
    member = deterministic_id(F.lit(jurisdiction), F.lit("member"), F.col("source_member_id"))
    return one.select(member.alias("member_id"), *(c.split()[0] for c in COLUMNS.split(", ")), F.current_timestamp().alias("retrieved_at"), F.lit(jurisdiction).alias("jurisdiction"))


#: The names of fields in the snapshots of the members' service.
SERVICE_FIELDS = {
    "source_member_id": "pm_Id", "title": "pm_Title", "first_name": "pm_FirstName", "other_names": "pm_OtherNames", "last_name": "pm_LastName", "date_of_birth": "pm_DateOfBirth",
    "house": "houseName", "electorate": "electorate", "party_name": "pp_name", "deceased": "pm_Deceased", "elected_date": "mb_ElectedDate", "archived_date": "pm_ArchiveDate",
}


def from_service_snapshots(spark: SparkSession, current: list[str], former: list[str], jurisdiction: str = "sa") -> DataFrame:
    """The register of a members' service; whoever is in both lists keeps the current row."""
    names = [*SERVICE_FIELDS.values(), "ho_name"]
    schema = ", ".join(f"{n} {'boolean' if n == 'pm_Deceased' else 'string'}" for n in names)
    read = lambda paths, is_current: spark.read.schema(schema).option("multiLine", True).json(paths).withColumn("is_current", F.lit(is_current))
    rows = read(current, True).unionByName(read(former, False)).where("pm_Id is not null")
    said = lambda c: F.nullif(F.trim(c), F.lit(""))
    columns = {name: F.col(field) if name == "deceased" else said(F.coalesce(field, "ho_name") if name == "house" else F.col(field)) for name, field in SERVICE_FIELDS.items()}
    rows = rows.select("is_current", *(any_date(c).alias(n) if n.endswith("_date") or n.startswith("date_") else c.alias(n) for n, c in columns.items()))
    one = preferred(rows.withColumn("display_name", F.concat_ws(" ", "first_name", "last_name")), ["source_member_id"], "archived_date")
    member = deterministic_id(F.lit(jurisdiction), F.lit("member"), F.col("source_member_id"))
    return one.select(member.alias("member_id"), *(c.split()[0] for c in COLUMNS.split(", ")), F.current_timestamp().alias("retrieved_at"), F.lit(jurisdiction).alias("jurisdiction"))


class _Rows(HTMLParser):
    """Rows of a page's tables: per cell its lines and its first link, and whether it is a heading."""

    def __init__(self, page: str):
        super().__init__()
        self.tables: list[list[list[dict]]] = []
        self.ids: list[str | None] = []
        self.feed(page)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        named = dict(attrs)
        if tag == "table":
            self.tables.append([])
            self.ids.append(named.get("id"))
        elif self.tables and tag == "tr":
            self.tables[-1].append([])
        elif self.tables and self.tables[-1] and tag in ("td", "th"):
            self.tables[-1][-1].append({"lines": [], "link": None})
        elif self.tables and self.tables[-1] and self.tables[-1][-1] and tag == "a":
            cell = self.tables[-1][-1][-1]
            cell["link"] = cell["link"] or named.get("href")

    def handle_data(self, data: str) -> None:
        if self.tables and self.tables[-1] and self.tables[-1][-1] and data.strip():
            self.tables[-1][-1][-1]["lines"].append(" ".join(data.split()))


HOUSES = {"LA": "Legislative Assembly", "LC": "Legislative Council"}
_TITLE = re.compile(r"(Mr|Mrs|Ms|Miss|Dr|The Hon\.?|Hon\.?|Rev(?:erend)?|Sir|Dame|Lady|Prof\.?)\s+(.*)")


def members_page(page: str, is_current: bool) -> list[dict]:
    """Members in the tables of a page: "Last, First" with a link that ends in ``pk=<id>``.

    The tables of current members name their columns; those of former ones hold
    the name, the date of birth and a note that may say "deceased".
    """
    out = []
    for table in _Rows(page).tables:
        heads = [" ".join(c["lines"]) for c in table[0]] if table else []
        for row in table[1:] if is_current else table:
            linked = next((c for c in row if c["link"] and re.search(r"pk=(\w+)", c["link"])), None)
            if linked is None:
                continue
            last, _, first = (x.strip() or None for x in " ".join(linked["lines"]).partition(","))
            titled = _TITLE.match(first or "")
            title, first = (titled[1], titled[2] or None) if titled and not is_current else (None, first)
            cells = dict(zip(heads, row, strict=False)) if is_current else {}
            said = lambda name, cells=cells: " ".join(cells[name]["lines"]) or None if name in cells else None
            seat = next((m[1] for line in cells.get("Position", {}).get("lines", ()) if (m := re.fullmatch(r"Member for (.+)", line))), None)
            others = [" ".join(c["lines"]) for c in row if c is not linked]
            out.append({
                "source_member_id": re.search(r"pk=(\w+)", linked["link"])[1], "display_name": " ".join(filter(None, (first, last))), "title": title, "first_name": first, "last_name": last, "is_current": is_current,
                "house": HOUSES.get(said("House") or "", said("House")), "electorate": seat, "party_name": said("Party"), "date_of_birth": next((x for x in others if re.fullmatch(r"\d{1,2}/\d{1,2}/\d{4}", x)), None) if not is_current else None,
                "deceased": any("deceased" in x.lower() for x in others) if not is_current and len(others) > 1 else None,
            })
    return out


def from_pages(spark: SparkSession, current: list[str], former: list[str], jurisdiction: str = "nsw") -> DataFrame:
    """The register of saved pages of current and former members, parsed where they lie."""
    fields = "source_member_id string, display_name string, title string, first_name string, last_name string, is_current boolean, house string, electorate string, party_name string, date_of_birth string, deceased boolean"
    names = [f.split()[0] for f in fields.split(", ")]

    def parsed(paths: list[str], is_current: bool) -> DataFrame:
        def run(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in pages:
                rows = [r for content in part["content"] for r in members_page(bytes(content).decode("utf-8", "replace"), is_current)]
                yield pd.DataFrame(rows, columns=names).astype(object)

        return spark.read.format("binaryFile").load(paths).select("content").mapInPandas(run, fields)

    rows = parsed(current, True).unionByName(parsed(former, False)).withColumn("date_of_birth", any_date(F.col("date_of_birth")))
    missing = [c for c in COLUMNS.split(", ") if c.split()[0] not in names]
    rows = preferred(rows.withColumns({c.split()[0]: F.lit(None).cast(c.split()[1]) for c in missing}), ["source_member_id"], "display_name")
    member = deterministic_id(F.lit(jurisdiction), F.lit("member"), F.col("source_member_id"))
    return rows.select(member.alias("member_id"), *(c.split()[0] for c in COLUMNS.split(", ")), F.current_timestamp().alias("retrieved_at"), F.lit(jurisdiction).alias("jurisdiction"))


def write_register(members: DataFrame, path: str) -> None:
    """Replace the register of the jurisdictions at hand."""
    overwrite_partitions(members, path, ["jurisdiction"])
