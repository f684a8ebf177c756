"""Schemas of the files that enter and leave."""

MANIFEST = "snapshot string, role string, url string, index_url string, issuer_ids array<string>, states array<string>, fetched_at string, status int, sha256 string, bytes_content long, content_type string, last_modified string, etag string, final_url string, was_gzip_payload boolean, elapsed_s double, error string, extra map<string,string>"
#: Leaves are text as published; lists may be published as single values, so they are text here too.
PROVIDER = "npi string, type string, name struct<first string, middle string, last string, suffix string>, facility_name string, facility_type string, gender string, sex string, accepting string, last_updated_on string, specialty string, languages string, addresses string, plans string"
ADDRESS = "array<struct<address string, address_2 string, city string, state string, zip string, phone string>>"
MEMBERSHIP = "array<struct<plan_id_type string, plan_id string, network_tier string, years string>>"
PLAN = "plan_id_type string, plan_id string, marketing_name string, summary_url string, network array<struct<network_tier string>>, last_updated_on string"
CORRECTION = "id string, issuer_id string, date string, status string, statement string, response string"
