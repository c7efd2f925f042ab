"""Declared schemas of the civic tables, for typed scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DDL = {
    "jurisdiction": "jurisdiction_id long, display_name string, jurisdiction_type string, state_abbr string, fips string, county_fips string, population long, timezone string, slug string",
    "governing_body": "body_id long, jurisdiction_id long, body_name string, body_type string",
    "seat": "seat_id long, body_id long, seat_name string, seat_type string, district_name string",
    "official": "official_id long, canonical_name string, first_name string, last_name string, is_elected boolean, is_active boolean, party string",
    "official_alias": "alias_id long, official_id long, alias string",
    "term": "term_id long, official_id long, seat_id long, start_date date, end_date date, is_current boolean",
    "meeting": "meeting_id long, body_id long, meeting_date date, meeting_time string, meeting_type string, agenda_url string, minutes_url string, packet_url string, posted_at timestamp, status string, meta string",
    "agenda_item": "item_id long, meeting_id long, item_number string, title string, description string, item_type string",
    "motion": "motion_id long, meeting_id long, title string, motion_type string, outcome string, petitioner string, staff_recommender string, tally_yes int, tally_no int, tally_abstain int, dollar_amount decimal(14,2), state string, source_page int",
    "vote": "vote_id long, motion_id long, official_id long, term_id long, vote_value string, reason string",
    "campaign_contribution": "contribution_id long, official_id long, contributor_name string, contributor_type string, amount decimal(12,2), received date, election_cycle_year int",
    "property_record": "record_id long, official_id long, parcel_id string, assessment_year int, assessed_value decimal(14,2), market_value decimal(14,2)",
    "government_budget": "jurisdiction_id long, fiscal_year int, total_revenues decimal(16,2), total_expenditures decimal(16,2), funds array<struct<name:string,revenues:decimal(16,2),expenditures:decimal(16,2)>>, provider string",
    "finding": "finding_id long, pattern_id string, severity int, title string, body_id long, official_id long, motion_id long, evidence array<struct<motion_id:bigint,day:date>>, metrics map<string,double>",
    "compliance_finding": "body_id long, category string, severity string, n long, status string, opened_at timestamp, closed_at timestamp",
    "fund_ledger": "entry_id long, jurisdiction_id long, kind string, amount decimal(14,6), created_at timestamp, job string",
    "pipeline_failure": "failure_id long, job string, step string, message string, meeting_id long, body_id long, context string, created_at timestamp, resolved_at timestamp",
    "extraction_outcome": "outcome_id long, jurisdiction_id long, method string, status string, anomaly_kinds map<string,int>, created_at timestamp",
    "document_text": "content_hash string, pages array<string>, n_chars long, verdict string",
    "jurisdiction_directory": "fips string, state_abbr string, name string, jurisdiction_type string, population long, nav_county_fips array<string>, covered_id long",
    "data_source": "data_source_id string, name string, url string, ingested_at timestamp, ingest_run_id string, jurisdiction_id long, notes string",
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A typed Parquet scan; columns that a file lacks are null, and only those a query names are read."""
    return spark.read.schema(DDL[name]).parquet(f"{root}/{name}")
