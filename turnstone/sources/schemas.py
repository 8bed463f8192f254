"""Schemas of the relational tables; fixed names and types, in order."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DateType, FloatType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

_KEYS = "fragment_id string, jurisdiction string, date string, house string"
_COLUMNS = {
    "fragments": "committee_name string, source_doc_id string, schema_version string, name string, venue string, parliament_num int, session_num int, parliament_name string, session_name string, review_stage string, start_time timestamp, end_time timestamp, start_page string, end_page string, lang string, source_url string, retrieved_at timestamp, extract_count int, content_hash string",
    "proceedings": "proceeding_id string, uid string, name string, continued boolean, document_order int",
    "subjects": "subject_id string, proceeding_id string, uid string, name string, names string, committee_name string, extract_index int, document_order int",
    "subproceedings": "subproceeding_id string, subject_id string, uid string, name string, document_order int",
    "clauses": "clause_id string, subject_id string, subproceeding_id string, uid string, name string, document_order int",
    "talkers": "talker_id string, proceeding_id string, subject_id string, subproceeding_id string, clause_id string, division_id string, uid string, member_source_id string, member_reference_id string, name string, role string, kind string, party string, party_source_id string, party_abbreviation string, electorate string, portfolios string, first_speech boolean, continued boolean, start_time timestamp, kind_inferred boolean, time_source string, clock_rolled boolean, paragraph_count int, word_count int, document_order int",
    "texts": "text_id string, proceeding_id string, subject_id string, subproceeding_id string, clause_id string, talker_id string, division_id string, source_id string, kind string, raw_text string, clean_text string, para_index int, page_no string, time_anchor timestamp, style string, mapped_style string, document_order int",
    "divisions": "division_id string, subject_id string, subproceeding_id string, clause_id string, uid string, source_id string, result string, ayes_count int, noes_count int, pairs_count int, abstentions_count int, document_order int",
    "division_votes": "vote_id string, division_id string, member_source_id string, member_name string, vote string, teller boolean, proxy boolean, proxy_source_id string, proxy_name string, party string",
    "bill_refs": "bill_ref_id string, subject_id string, uid string, source_id string, reference_id string, name string",
    "attendees": "attendee_id string, kind string, name string, reference_id string",
    "meeting_time_marks": "mark_id string, kind string, time timestamp, label string",
}
_TYPES = {"string": StringType(), "int": IntegerType(), "bigint": LongType(), "float": FloatType(), "boolean": BooleanType(), "date": DateType(), "timestamp": TimestampType(), "array<float>": ArrayType(FloatType())}


def _schema(columns: str) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(","))])


TABLES: dict[str, StructType] = {name: _schema(f"{_KEYS}, {columns}") for name, columns in _COLUMNS.items()}
PARTITIONS = ["jurisdiction", "date", "house"]

#: Tables that do not come from transcripts.
SIDE_TABLES: dict[str, StructType] = {
    name: _schema(columns)
    for name, columns in {
        "members": "member_id string, source_member_id string, display_name string, title string, first_name string, other_names string, last_name string, date_of_birth date, house string, electorate string, party_name string, is_current boolean, deceased boolean, elected_date date, archived_date date, retrieved_at timestamp, jurisdiction string",
        "subject_themes": "subject_id string, fragment_id string, theme_id string, theme_name string, rank int, score float, engine string, model string, provider string, taxonomy_locale string, taxonomy_version int, model_slug string, jurisdiction string, date string, house string",
        "embeddings": "text_id string, fragment_id string, talker_id string, subject_id string, model string, provider string, dim int, embedding array<float>, model_slug string, jurisdiction string, date string, house string",
        "stage_vocab": "jurisdiction string, name_lower string, stage string, stage_order int",
        "raw_days": "jurisdiction string, date date, house_code string, documents bigint, harvested_at string",
        "embedding_index": "model_slug string, jurisdiction string, date string, house string",
    }.items()
}

#: Files that could not be read, by the day they belong to.
PARSE_ERRORS = _schema("jurisdiction string, date string, house string, name string, error string")
