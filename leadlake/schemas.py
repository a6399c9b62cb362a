"""Fixed schemas of the layers and of the source payloads, as DDL text."""


BRONZE_LEAD = (
    "lead_id string, source string, first_name string, last_name string, email string, job_title string, "
    "seniority string, linkedin_url string, company_name string, company_domain string, industry string, "
    "employee_count int, apollo_score double, lead_status string, phone string, ingested_at string, "
    "event_type string"
)

PERSON_PAYLOAD = (
    "id string, first_name string, last_name string, email string, title string, seniority string, "
    "linkedin_url string, score double, organization struct<name: string, primary_domain: string, "
    "industry: string, linkedin_url: string, estimated_num_employees: int>"
)

CONTACT_PAYLOAD = (
    "id string, properties struct<firstname: string, lastname: string, email: string, company: string, "
    "jobtitle: string, phone: string, hs_lead_status: string, createdate: string>"
)

# Answers of the three insight stages.
ENRICHMENT = (
    "company_summary string, company_stage string, likely_tech_stack array<string>, pain_points array<string>, "
    "buying_readiness string, best_contact_channel string, enrichment_confidence int"
)
INTENT = (
    "intent_score int, intent_level string, intent_signals array<string>, urgency string, "
    "deal_size_estimate string, next_best_action string, ai_reasoning string"
)
OUTREACH = "email_subject string, email_body string, cadence array<string>"
