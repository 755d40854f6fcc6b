"""Target records per object (B2) and the selections that feed them.

The field maps are data: target field, source column and kind.  Constants that differ
between target systems (record types, journal types, programme, run time) are parameters.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import iso_date, iso_utc
from .batch import require

#: Fixed values: (target field, source column, kind) by object.  Kinds: ``=`` the value as it is,
#: ``utc`` ISO-8601 instant, ``day`` ISO date, ``bool`` a 0/1 flag with NULL kept, ``flag`` a 0/1 flag with NULL as
#: false, ``fit40`` the first 40 characters or NULL, ``true`` the constant, ``:text`` a constant text, ``param`` a parameter.
FIELD_MAPS: dict[str, list[tuple[str, str, str]]] = {
    "contact": [
        ("ClusterID__c", "cluster_id", "="), ("RecordTypeId", "record_type", "param"), ("ClusterID__pc", "cluster_id", "="),
        ("SourceSystem__c", "source", "="), ("InvestmentStatus__pc", "investor_status", "="),
        ("InvestmentExpirationDate__pc", "investor_expiration_date", "utc"),
        ("FirstName", "clean_first_name", "="), ("LastName", "clean_last_name", "="), ("Salutation", "salutation", "="),
        ("PersonEmail", "clean_email", "="), ("PersonMobilePhone", "phone", "="), ("Birthdate", "birth_date", "utc"),
        ("PersonGenderIdentity", "gender", "="), ("BillingStreet", "address", "="), ("BillingCity", "city", "="),
        ("BillingPostalCode", "postal_code", "="), ("BillingCountryCode__c", "country", "="), ("Phone", "phone", "="),
        ("BirthPlace__pc", "birth_place", "="), ("NationalityCountryCode__pc", "nationality", "="),
        ("PreferredLanguage__pc", "language", "="), ("SourceSystem__pc", "source", "="),
    ],
    "contact_update": [
        ("Id", "sf_account_id", "="), ("ExternalID__pc", "external_id", "="), ("SourceSystem__pc", "source", "="),
        ("PersonBirthdate", "birth_date", "day"), ("InvestCustomer__pc", "invest_customer", "bool"),
        ("InvestmentStatus__pc", "investment_status", "="), ("InvestmentExpirationDate__pc", "investment_expiration_date", "day"),
    ],
    "member": [
        ("MembershipNumber", "member_number_new", "="), ("LegacyMemberId__c", "legacy_member_number", "="),
        ("LegacyTier__c", "member_tier", "="),
    ],
    "member_update": [
        ("Id", "sf_loyalty_member_id", "="), ("LegacyTier__c", "loyalty_legacy_tier", "="),
        ("LegacyMemberId__c", "loyalty_legacy_number", "="),
    ],
    "reservation": [
        ("ReservationID__c", "reservation_id", "="), ("LoyaltyPointsAwarded__c", "", "true"), ("BookingID__c", "booking_id", "="),
        ("ReservationStatus__c", "reservation_status", "="), ("MarketSegmentCode__c", "market_segment", "="),
        ("SourceSystem__c", "source", "="), ("Source__c", "source", "="), ("ClusterID__c", "cluster_id", "="),
        ("RateCode__c", "rate_plan_code", "="), ("ConsentCentral__c", "central_consent", "flag"), ("ConsentProperty__c", "", "true"),
        ("BookingDate__c", "booking_at", "utc"), ("Arrival__c", "arrival_at", "utc"), ("Departure__c", "departure_at", "utc"),
        ("CheckIn__c", "checkin_at", "utc"), ("CheckOut__c", "checkout_at", "utc"), ("CancellationAt__c", "cancelled_at", "utc"),
        ("NoShowAt__c", "noshow_at", "utc"), ("RoomNights__c", "room_nights", "="), ("Adults__c", "adults_num", "="),
        ("ChildrenCount__c", "children_num", "="), ("GuestRole__c", "guest_role", "="), ("TotalRevenue__c", "revenue_total", "="),
        ("FBRevenue__c", "revenue_fnb", "="), ("RoomRevenue__c", "revenue_room", "="), ("OtherRevenue__c", "revenue_extra", "="),
        ("Property__c", "sf_property_id", "="), ("ChannelCode__c", "market_channel", "="), ("BookingGroupID__c", "group_name", "="),
        ("CRSBookingID__c", "external_code", "="), ("TravelPurpose__c", "travel_purpose", "="), ("CompanyID__c", "booker_company_id", "="),
        ("ProfileTitle__c", "salutation", "="), ("ProfileFirstName__c", "first_name", "="), ("ProfileMiddleName__c", "middle_name", "="),
        ("ProfileLastName__c", "last_name", "="), ("ProfileEmail__c", "email", "valid"), ("ProfileEmailRaw__c", "email", "="),
        ("ProfileMobilePhone__c", "phone", "="), ("ProfileBirthdate__c", "birth_date", "utc"), ("ProfileBirthPlace__c", "birth_place", "="),
        ("ProfileGenderIdentity__c", "gender", "="), ("ProfilePreferredLanguage__c", "preferred_language", "="),
        ("ProfileNationalityCountryCode__c", "nationality", "="), ("ProfileMailingStreet__c", "address", "="),
        ("ProfileMailingPostalCode__c", "postal_code", "="), ("ProfileMailingCity__c", "city", "fit40"),
        ("ProfileMailingCountry__c", "country", "="), ("ProfileSourceSystem__c", "source", "="),
    ],
    "consent": [
        ("Name", "consent_type", "="), ("ContactPointId", "cpe_id", "="), ("CaptureDate", "today", "param"), ("CaptureSource", "source", "="),
        ("PrivacyConsentStatus", "OptIn", ":text"), ("DataUsePurposeId", "data_use_purpose", "="), ("Property__c", "sf_property_id", "="),
        ("EffectiveFrom", "today", "param"), ("SourceSystem__c", "source", "="),
    ],
    "optout": [("Id", "cpc_id", "="), ("PrivacyConsentStatus", "OptOut", ":text"), ("EffectiveTo", "today", "param")],
    "journal": [
        ("ActivityDate", "now", "param"), ("Status", "Pending", ":text"), ("MemberId", "sf_loyalty_member_id", "="),
        ("JournalTypeId", "journal_type", "param"), ("JournalSubTypeId", "journal_subtype", "param"),
        ("LoyaltyProgramId", "program", "param"), ("Points__c", "loyalty_points_balance", "="),
        ("SourceSystem__c", "source_system", "param"), ("Description__c", "description", "param"),
    ],
    "preference": [
        ("Name", "preference_name", "="), ("Category__c", "preference_category", "="), ("Contact__c", "contact_id", "="),
        ("ExternalID__c", "external_id", "="), ("IsActive__c", "", "true"), ("SourceSystem__c", "source_system", "="),
    ],
    "property": [
        ("GroupID__c", "group_id", "="), ("PropertyCode__c", "code", "="), ("PmsID__c", "pms_id", "="), ("PMS__c", "pms", "="),
        ("FormID__c", "form_id", "="),
    ],
    "rate_code": [
        ("RateCode__c", "rate_code", "="), ("Name", "name", "="), ("RateCodeCategory__c", "category", "="),
        ("RateType__c", "market_segment", "="), ("RateDescription__c", "description", "="),
    ],
}
#: Objects whose records write NULL as an empty text (clearing the field; the others leave
#: it out), and the field that a record must have.
CLEARING = {"reservation"}
REQUIRED = {"reservation": "ReservationID__c"}


def _field(name: str, source: str, kind: str, present: set[str], params: Mapping[str, str]) -> Column:
    c = F.col(source) if source in present else F.lit(None).cast("string")
    if kind == "true":
        out = F.lit(True)
    elif kind == "param":
        out = F.lit(params[source]).cast("string")
    elif kind == ":text":
        out = F.lit(source)
    elif kind == "utc":
        out = iso_utc(c)
    elif kind == "day":
        out = iso_date(c)
    elif kind == "bool":
        out = c.cast("int") != 0
    elif kind == "flag":
        out = F.coalesce(c.cast("int"), F.lit(0)) != 0
    elif kind == "fit40":
        out = F.nullif(F.substring(c, 1, 40), F.lit(""))
    elif kind == "valid":
        bad = F.coalesce(F.col("is_email_invalid").cast("int"), F.lit(0)) != 0 if "is_email_invalid" in present else F.lit(False)
        out = F.when(~bad, c)
    else:
        out = c
    return out.alias(name)


def target_records(df: DataFrame, object_name: str, params: Mapping[str, str] | None = None) -> DataFrame:
    """Records of one target object (B2), one per row, in the order of its field map.

    A source column that ``df`` lacks is NULL.  For the clearing objects NULL becomes an empty text
    (all their fields are text then, flags ``True``/``False``); a missing required field fails the job."""
    present = set(df.columns)
    out = df.select(*[_field(*f, present, params or {}) for f in FIELD_MAPS[object_name]])
    if object_name in REQUIRED:
        key = REQUIRED[object_name]
        out = require(out.withColumn(key, F.nullif(F.col(key).cast("string"), F.lit(""))), key, f"Missing {key}")
    if object_name in CLEARING:
        text = lambda f: F.initcap(F.col(f.name).cast("string")) if f.dataType.typeName() == "boolean" else F.col(f.name).cast("string")
        out = out.select(*[F.coalesce(text(f), F.lit("")).alias(f.name) for f in out.schema.fields])
    return out


# ---- selections

def active_properties(props: DataFrame, active: str = "is_active", form_id: str = "form_id") -> DataFrame:
    """Active properties that have a form id."""
    return props.where((F.col(active) == 1) & F.col(form_id).isNotNull())


def rate_codes(overview: DataFrame, name: str = "plan_name", code: str = "rate_code") -> DataFrame:
    """Rate codes with a name (the plan's, else the code)."""
    return overview.withColumn("name", F.coalesce(name, code))


def loyal_accounts(accounts: DataFrame, ids: DataFrame, key: str, id_key: str, enrolled: str,
                   active: str = "has_active_loyalty") -> DataFrame:
    """Accounts with an active membership that have target ids (one row per match), with the enrolment date."""
    i = ids.withColumnRenamed(id_key, "__id_key")
    return (accounts.where(F.col(active) == 1).join(i, F.col(key) == F.col("__id_key")).drop("__id_key")
            .withColumn("enrollment_date", F.lit(enrolled).cast("date")))


def open_reservations(res: DataFrame, departing_from: str) -> DataFrame:
    """Confirmed reservations that are not excluded, not in the target yet, and depart at or after a day."""
    return res.where((F.col("reservation_status") == "Confirmed") & F.col("sf_reservation_id").isNull()
                     & (F.col("departure_at") >= F.to_timestamp_ntz(F.lit(departing_from))) & (F.col("_excluded") == 0))
