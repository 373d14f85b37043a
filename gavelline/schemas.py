"""Schemas of the tables at rest."""

LOT_TEXT = (
    "source_location string, sale_date date, sale_number string, broker string, mark string, grade string, "
    "lot_number string, invoice_number string, quantity_kgs double, package_count double"
)
AUCTION_SALES = LOT_TEXT + ", price double, buyer string, source_file_identifier string, processed_timestamp timestamp"
AUCTION_OFFERS = LOT_TEXT + ", valuation_or_rp double, source_file_identifier string, processed_timestamp timestamp"
GRADE_SUMMARY = (
    "source_location string, sale_date date, sale_number string, auction_type string, grade string, lots bigint, "
    "quantity_kgs double"
)
MARKET_COMMENTARY = (
    "source_location string, report_date date, sale_number string, content_type string, content string, "
    "source_file string"
)
PROCESSING_LOG = (
    "file_identifier string, processed_timestamp timestamp, records_inserted bigint, data_type string, status string"
)
CERTIFICATION_HISTORY = (
    "certificateholder_id string, certificateholder_name string, crop string, license_number string, "
    "start_date_license date, end_date_license date, license_standard string, license_status string, scope string, "
    "region string, country string, ingestion_timestamp timestamp, batch_id string"
)
ARTICLES = (
    "seq bigint, headline string, snippet string, source string, link string, scraped_date timestamp, "
    "article_date string"
)
REPORTS = (
    "report_id string, title string, description string, auction_centre string, week_number int, year int, "
    "source string, report_link string, scraped_at timestamp"
)
RESULTS = (
    "report_id string, lot_number string, garden_name string, tea_grade string, quantity_kg double, price double"
)
INDEX_ENTRY = (
    "sale_number string, sale_num_only string, sale_date string, year string, filename string, location string, "
    "snapshot string"
)
DATASETS = "title string, period string, description string, source string, tags array<string>, link string"
GLOBAL_STATISTICS = (
    "current_year int, previous_year int, last_updated string, "
    "production_statistics_mkg array<struct<region:string, as_of_month:string, current_year_todate:double, "
    "previous_year_todate:double, difference:double, source:string>>, "
    "sales_channel_statistics_kg map<string, struct<as_of_date:string, channels:array<struct<channel:string, "
    "current_year_todate:double, previous_year_todate:double>>>>"
)
IMPORTS = "partner_country string, net_mass_kg double, value_gbp double"
JOBS = (
    "title string, company string, location string, type string, snippet string, link string, "
    "description struct<intro:string, responsibilities:array<string>, qualifications:array<string>>"
)
SAVES = "user_id string, item_type string, item_id string"
PRICE_PAYLOADS = "centre string, sale string, body string"
GRID = "file string, sheet int, row_pos bigint, cells array<string>"
