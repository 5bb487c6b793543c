"""Record types: content structs, value rules and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Record types, their fields, the rules of their values, and the queues.
RECORD_TYPES = ["STARTUP", "PRODUCT", "RESEARCH_PAPER", "JOB", "NEWS"]
CONTENT = {
    "STARTUP": "entity_name string, description string, employee_count int, website string, founded_year int, location string, batch string",
    "PRODUCT": "product_name string, startup_name string, pricing_model string, website string, description string, tagline string, tags array<string>, upvotes int",
    "RESEARCH_PAPER": "title string, authors array<string>, paper_url string, github_url string, github_stars int, published_date timestamp, abstract string, external_id string, category string, pdf_url string",
    "JOB": "company string, role string, date timestamp, is_remote boolean, role_family string, location string, description string, application_url string, salary_min double, salary_max double, salary_currency string",
    "NEWS": "title string, body string, published_date timestamp, author string, summary string, image_url string",
}
RULES = {
    "STARTUP": {"entity_name": "entity_name is not null", "employee_count": "coalesce(employee_count >= 0, true)", "founded_year": "coalesce(founded_year between 1900 and 2100, true)"},
    "PRODUCT": {"product_name": "product_name is not null", "pricing_model": "coalesce(pricing_model in ('FREE','FREEMIUM','PAID','ENTERPRISE'), true)", "upvotes": "coalesce(upvotes >= 0, true)"},
    "RESEARCH_PAPER": {"title": "title is not null", "paper_url": "paper_url is not null", "github_stars": "coalesce(github_stars >= 0, true)"},
    "JOB": {"company": "company is not null", "role": "role is not null", "salary_min": "coalesce(salary_min >= 0, true)", "salary_max": "coalesce(salary_max >= 0, true)"},
    "NEWS": {"title": "title is not null", "body": "body is not null"},
}
QUEUES = ["crawl:startup", "crawl:product", "crawl:paper", "crawl:news", "crawl:job", "extract", "enrich:github", "resolve:entity", "export:sheets", "deadletter"]


def violations(record_type: str) -> Column:
    """Names of the fields that break a rule of the record type, in order."""
    broken = [F.when(~F.expr(rule), F.lit(field)) for field, rule in RULES[record_type].items()]
    return F.filter(F.array(*broken), lambda x: x.isNotNull())
# The stored tables and their columns.
TABLES = {
    "sources": "id bigint, name string, base_url string, source_type string, enabled boolean, created_at timestamp",
    "crawl_runs": "id string, source_id bigint, started_at timestamp, finished_at timestamp, status string, discovered_count int, success_count int, failure_count int",
    "raw_documents": "id string, source_id bigint, url string, normalized_url string, content_hash string, http_status int, content_type string, raw_html string, clean_text string, fetched_at timestamp, first_seen_at timestamp, last_seen_at timestamp, extra_metadata string",
    "startups": "id string, canonical_name string, description string, employee_count int, website string, founded_year int, location string, batch string, source_url string, source_name string, provenance string, collected_at timestamp",
    "products": "id string, product_name string, startup_id string, pricing_model string, website string, description string, tagline string, source_url string, provenance string, collected_at timestamp",
    "research_papers": "id string, external_id string, title string, authors array<string>, paper_url string, github_url string, github_stars int, github_match_confidence double, published_date timestamp, abstract string, category string, provenance string, collected_at timestamp",
    "jobs": "id string, source_url string, company string, role string, published_at timestamp, is_remote boolean, role_family string, location string, description string, application_url string, date_source string, date_confidence double, content_hash string, provenance string, collected_at timestamp",
    "news": "id string, source_url string, title string, body string, published_at timestamp, author string, date_source string, date_confidence double, content_hash string, provenance string, collected_at timestamp",
    "entity_aliases": "id bigint, raw_name string, normalized_name string, canonical_name string, entity_type string, method string, confidence double",
    "entity_mapping_logs": "id string, raw_name string, canonical_name string, entity_type string, method string, confidence double, source_url string, created_at timestamp",
    "github_repositories": "id string, repository_url string, owner string, repo string, stars int, description string, fetched_at timestamp, raw_response string",
}
