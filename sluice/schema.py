"""Schemas of the layers, as DDL."""

BRONZE = (
    "raw_id long, source string, source_job_id string, payload string, payload_hash string, "
    "first_seen_at timestamp, last_seen_at timestamp, first_run_id long"
)
SILVER = (
    "job_id long, raw_id long, source string, source_job_id string, title string, company string, location string, "
    "country string, is_remote boolean, employment_type string, salary_min decimal(14,2), salary_max decimal(14,2), "
    "salary_currency string, salary_period string, salary_usd_year_min decimal(14,2), salary_usd_year_max decimal(14,2), "
    "posted_at timestamp, url string, description string, content_hash string, dedupe_key string, is_duplicate boolean, "
    "is_tech boolean, keyword_skills array<string>, updated_at timestamp"
)
EXTRACTIONS = (
    "job_id long, content_hash string, prompt_version string, model string, role_family string, seniority string, "
    "years_experience_min int, remote_policy string, skills array<string>, extracted_at timestamp"
)
RUNS = "run_id long, started_at timestamp, finished_at timestamp, status string, stats string, error string"
DQ = "run_id long, check_name string, severity string, passed boolean, failing_rows long, details string, checked_at timestamp"
VECTORS = "job_id long, document string, doc_hash string, embedding array<float>"
