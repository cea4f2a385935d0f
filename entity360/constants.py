"""Fixed values. Results depend on these exact texts and numbers."""

from pyspark.sql import types as T

# Source systems.
HUBSPOT = "hubspot"
OFFICERND = "officernd"
BIGTIME = "bigtime"
SYSTEMS = (HUBSPOT, OFFICERND, BIGTIME)

# Typed associations in the CRM.
PRIMARY_COMPANY_CATEGORY = "HUBSPOT_DEFINED"
PRIMARY_COMPANY_TYPE = 5
PROJECT_STARTUP_TYPE = 105
PROJECT_PARTNER_TYPE = 107

# Engagement vocabulary.
BUSINESS = "Business"
DEAL = "deal"
MEMBERSHIP = "membership"
PROJECT = "project"
ENGAGEMENT_TYPES = (DEAL, MEMBERSHIP, PROJECT)

# First part of each event key.
DEAL_KEY = "hubspot_deal"
STARTUP_PROJECT_KEY = "hubspot_startup_project"
MEMBERSHIP_KEY = "officernd_membership"
SERVICES_PROJECT_KEY = "bigtime_project"
KEY_SEPARATOR = "|"

# Status vocabulary.
DEAL_STATUSES = ("won", "lost", "open")
MEMBERSHIP_STATUSES = ("active", "expired", "not_started", "not_approved")
UNKNOWN = "unknown"
ACTIVE = "active"
INACTIVE = "inactive"
EXPIRED = "expired"
NOT_STARTED = "not_started"
ACTIVE_MEMBER = "active_member"
FORMER_MEMBER = "former_member"
NO_MEMBERSHIP = "no_membership_record"
UNCATEGORIZED = "Uncategorized"

# Array and report limits.
TIMELINE_LIMIT = 20
RECENT_LIMIT = 10
TYPED_LIMIT = 10
STATUS_LIMIT = 10
PLAN_LIMIT = 25
SAMPLE_ID_LIMIT = 20
REPORT_LIMIT = 100

# Money is added up exactly, at nine decimals, and published as double. Amounts that this type
# can't hold well (NaN, infinite, beyond its range, or tiny) are added up as doubles.
MONEY = T.DecimalType(28, 9)
MONEY_RANGE = 1e19
MONEY_LEAST = 1e-3
