"""Table layouts, as DDL, and the fixed seed rows of the dimensions."""

from __future__ import annotations

EVENT_FIELDS = [
    "badge_id",
    "user_id",
    "zone_id",
    "reader_id",
    "event_timestamp",
    "signal_strength",
    "direction",
]
ID_FIELDS = ["badge_id", "user_id", "zone_id", "reader_id"]

SIGNAL_TYPE = "decimal(5,2)"

RAW_COLUMNS = [
    "badge_id",
    "user_id",
    "zone_id",
    "reader_id",
    "event_timestamp",
    "signal_strength",
    "signal_quality",
    "direction",
    "ingestion_time",
]

RAW_SCHEMA = """
    badge_id string, user_id string, zone_id string, reader_id string,
    event_timestamp timestamp_ntz, signal_strength decimal(5,2),
    signal_quality string, direction string, ingestion_time timestamp_ntz,
    raw_json string
"""

# The landing table also keeps lines that failed, in their own partition.
LANDING_SCHEMA = RAW_SCHEMA.rstrip() + ", reject_reasons array<string>, status string"

STAGING_SCHEMA = """
    badge_id string, user_id string, zone_id string, reader_id string,
    event_timestamp timestamp_ntz, signal_strength decimal(5,2),
    signal_quality string, direction string, ingestion_time timestamp_ntz,
    staging_time timestamp_ntz, _batch_id long
"""

USER_SCHEMA = """
    user_key long, user_id string, user_name string, user_type string,
    department string, email string, phone string, clearance_level string,
    is_active boolean, effective_start_date timestamp_ntz,
    effective_end_date timestamp_ntz, is_current boolean,
    created_timestamp timestamp_ntz, updated_timestamp timestamp_ntz
"""

ZONE_SCHEMA = """
    zone_key long, zone_id string, reader_id string, building_name string,
    floor_number int, zone_name string, zone_type string, capacity long,
    requires_clearance string, is_monitored boolean, is_restricted boolean,
    reader_location string, reader_type string, latitude decimal(10,6),
    longitude decimal(10,6), created_timestamp timestamp_ntz,
    updated_timestamp timestamp_ntz
"""

FACT_COLUMNS = [
    "user_key",
    "zone_key",
    "badge_id",
    "reader_id",
    "event_timestamp",
    "event_date",
    "event_hour",
    "event_day_of_week",
    "direction",
    "signal_strength",
    "signal_quality",
    "is_restricted_access",
    "is_after_hours",
    "is_weekend",
    "ingestion_time",
    "fact_load_time",
]

FACT_SCHEMA = """
    event_key long, user_key long, zone_key long, badge_id string,
    reader_id string, event_timestamp timestamp_ntz, event_hour int,
    event_day_of_week int, direction string, signal_strength decimal(5,2),
    signal_quality string, is_restricted_access boolean,
    is_after_hours boolean, is_weekend boolean,
    ingestion_time timestamp_ntz, fact_load_time timestamp_ntz, event_date date
"""

INGEST_LOG_SCHEMA = """
    channel_name string, pipe_name string, server_timestamp timestamp_ntz,
    rows_parsed long, rows_inserted long, rows_error_count long,
    bytes_inserted long, last_error_message string
"""

RUN_LOG_SCHEMA = """
    name string, state string, scheduled_time timestamp_ntz,
    completed_time timestamp_ntz, error_code string, error_message string
"""

# The members every deployment starts with.
SEED_USERS = [
    ("USR-001", "John Smith", "EMPLOYEE", "Engineering", "CONFIDENTIAL"),
    ("USR-002", "Jane Doe", "EMPLOYEE", "HR", "PUBLIC"),
    ("USR-003", "Bob Johnson", "CONTRACTOR", "IT Support", "PUBLIC"),
    ("USR-004", "Alice Williams", "EMPLOYEE", "Security", "SECRET"),
    ("USR-005", "Mike Davis", "VISITOR", "External", "PUBLIC"),
]
SEED_ZONES = [
    ("ZONE-LOBBY-1", "RDR-101", "Main Building", 1, "Main Lobby", "LOBBY",
     100, None, False, "Main Entrance", "BIDIRECTIONAL"),
    ("ZONE-OFFICE-2A", "RDR-201", "Main Building", 2, "Engineering Office 2A", "OFFICE",
     30, "CONFIDENTIAL", True, "Floor 2 East", "ENTRY"),
    ("ZONE-SERVER-B1", "RDR-B101", "Main Building", -1, "Server Room B1", "SECURE_AREA",
     5, "SECRET", True, "Basement Security Door", "BIDIRECTIONAL"),
    ("ZONE-CONF-3B", "RDR-301", "Main Building", 3, "Conference Room 3B", "CONFERENCE_ROOM",
     20, None, False, "Floor 3 West", "ENTRY"),
    ("ZONE-PARKING-1", "RDR-P01", "Parking Structure", 1, "Employee Parking Level 1", "PARKING",
     200, None, False, "Garage Entry", "ENTRY"),
]
