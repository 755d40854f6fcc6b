"""Object extracts of the CRM.

The HTTP paging client is not built: pages are landed as JSON files by any
fetcher (one JSON document per page with ``totalSize``, ``done`` and a
``records`` array whose elements carry an ``attributes`` metadata object).
Spark reads all pages in parallel and flattens them here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Date fields of the extracts (typed on load, the rest stays text).
DATE_FIELDS = [
    "CreatedDate", "LastModifiedDate", "LastActivityDate", "LastViewedDate", "LastReferencedDate",
    "SystemModstamp", "EmailBouncedDate", "ConvertedDate", "CaptureDate", "EffectiveFrom", "EffectiveTo",
    "ActivityDate", "CloseDate", "StartDate", "EndDate", "Birthdate", "PersonBirthdate",
]

#: Extract columns by object, in extract order; the property object is extracted with all its fields.
OBJECT_COLUMNS = {
    "Account": """
        Id PersonContactId PersonIndividualId IsPersonAccount RecordTypeId OwnerId CreatedDate LastModifiedDate
        LastSourceSystemUpdate__c SourceSystem__pc SourceSystem__c SourceOrigin__pc SourceSystemIdentifier ExternalID__pc
        EntraExternalID__pc ClusterID__pc ClusterID__c Salutation FirstName MiddleName LastName Suffix PersonTitle
        PersonGenderIdentity PersonPronouns PersonBirthdate BirthdateString__pc BirthPlace__pc NationalityCountryCode__pc
        PreferredLanguage__pc RegionCode__pc PersonEmail PersonEmailBouncedDate PersonEmailBouncedReason
        PersonHasOptedOutOfEmail PersonMobilePhone PersonHomePhone PersonOtherPhone PersonAssistantPhone PersonAssistantName
        PersonDepartment PersonDoNotCall Phone Fax PersonHasOptedOutOfFax BillingStreet BillingCity BillingState
        BillingPostalCode BillingCountry BillingCountryCode__c BillingEmail__c PersonMailingStreet PersonMailingCity
        PersonMailingState PersonMailingPostalCode PersonMailingCountry PersonOtherStreet PersonOtherCity PersonOtherState
        PersonOtherPostalCode PersonOtherCountry HotelCustomer__pc CampingCustomer__pc ResidencesCustomer__pc
        InvestCustomer__pc InvestmentStatus__pc InvestmentExpirationDate__pc IsMasterAccount__c CustomerSinceDate__c
        SyncToMcHotelCampingResidences__pc SyncToMcInvest__pc StopSalesEmail__c PrimaryProperty__pc PrimarySalesOwner__c
        ParentId""".split(),
    "Lead": """
        id FirstName LastName Title Email Country CountryCode__c BillingEmail__c HotelCustomer__c ClusterID__c Status
        PreferredLanguage__c BirthdateString__c CreatedDate MatchBestConfidence__c MatchCandidateCount__c MatchCheckDue__c
        MatchCheckNotBefore__c MatchCheckRequested__c MatchCheckStatus__c MatchResult__c MatchCheckedBy__c
        RelatedPersonAccount__c RelatedContact__c LastMatchCheckedAt__c MatchCheckAttempts__c MatchedContact__c
        MatchManualReviewResolvedAt__c MatchManualReviewStatus__c""".split(),
    "LoyaltyProgramMember": """
        Id MembershipNumber ExternalMemberId__c MemberStatus ContactId ProgramId LegacyMemberId__c LegacyTier__c TierName__c
        LastActivityDate EntraID__c CreatedDate""".split(),
    "Property__c": None,
    "ContactPointEmail": """
        EmailAddress Id ParentId PartyID__c LastModifiedDate CreatedDate SourceSystem__c""".split(),
    "ContactPointConsent": """
        Id Name ContactPointId PrivacyConsentStatus CaptureSource CaptureDate EffectiveFrom EffectiveTo PartyId ConsentKey__c
        Property__c SourceSystem__c LastModifiedDate CreatedDate""".split(),
    "Reservation__c": """
        Id Name IsDeleted CreatedDate LastModifiedDate ReservationID__c ClusterID__c SFID__c SourceSystem__c Source__c
        ReservationStatus__c BookingID__c CRSBookingID__c BookingGroupID__c Property__c PropertyType__c UnitID__c
        RoomNights__c RateCode__c MarketSegmentCode__c ChannelCode__c BookingDate__c Arrival__c Departure__c CheckIn__c
        CheckOut__c CancellationAt__c NoShowAt__c Adults__c ChildrenCount__c Guest__c Contact__c Lead__c BookerCompany__c
        GuestRole__c IsPrimaryBooker__c ConsentCentral__c ConsentProperty__c TotalRevenue__c RoomRevenue__c FBRevenue__c
        OtherRevenue__c ProfileTitle__c ProfileFirstName__c ProfileMiddleName__c ProfileLastName__c ProfileEmail__c
        ProfileMobilePhone__c ProfileBirthdate__c ProfileBirthPlace__c ProfileGenderIdentity__c ProfilePreferredLanguage__c
        ProfileNationalityCountryCode__c ProfileSourceSystem__c ProfileMailingStreet__c ProfileMailingPostalCode__c
        ProfileMailingCity__c ProfileMailingCountry__c ProfileMatchingStatus__c ProfileMatchingMethod__c
        ProfileMatchingConfidence__c TravelPurpose__c""".split(),
}
#: Fixed value: objects whose extract takes deleted rows too.
WITH_DELETED = {"Property__c"}


def page_schema(record: T.StructType) -> T.StructType:
    """Schema of one landed page for a record schema (declared, never inferred)."""
    attrs = T.StructType([T.StructField("type", T.StringType()), T.StructField("url", T.StringType())])
    rec = T.StructType([T.StructField("attributes", attrs)] + list(record.fields))
    return T.StructType([T.StructField("totalSize", T.LongType()), T.StructField("done", T.BooleanType()),
                         T.StructField("records", T.ArrayType(rec))])


def read_object_pages(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    return spark.read.schema(page_schema(record)).json(path)


def flatten_object_pages(pages: DataFrame, total_col: str = "total_size") -> DataFrame:
    """Landed pages -> one row per record without the ``attributes`` metadata,
    plus the total record count the service reported (S6)."""
    r = pages.select(F.col("totalSize").alias(total_col), F.explode("records").alias("r"))
    return r.select("r.*", total_col).drop("attributes")


def select_spec(df: DataFrame, obj: str, columns: Sequence[str] | None = None,
                deleted_col: str = "IsDeleted") -> DataFrame:
    """Apply an object's extract (S7): its columns (or ``columns``, or all) of the rows
    that are not deleted.  Columns that the landed records lack are NULL text."""
    cols = list(columns) if columns is not None else OBJECT_COLUMNS[obj]
    if obj not in WITH_DELETED and deleted_col in df.columns:
        df = df.where(~F.coalesce(F.col(deleted_col).cast("boolean"), F.lit(False)))
    if not cols:
        return df
    have = {c.lower() for c in df.columns}
    return df.select(*[F.col(c).alias(c) if c.lower() in have else F.lit(None).cast("string").alias(c) for c in cols])


def audit_pages(pages: DataFrame) -> DataFrame:
    """One row about the landed pages of an extract (S6): n_pages, n_records, total_size and whether they are complete, that is the
    records are as many as the service reported, every page reported the same, and one page is marked as the last."""
    return pages.agg(
        F.count(F.lit(1)).alias("n_pages"), F.coalesce(F.sum(F.size("records")), F.lit(0)).alias("n_records"),
        F.max("totalSize").alias("total_size"), F.min("totalSize").alias("__least"), F.count_if(F.col("done")).alias("__last")).select(
        "n_pages", "n_records", "total_size",
        F.coalesce((F.col("n_records") == F.col("total_size")) & (F.col("total_size") == F.col("__least")) & (F.col("__last") == 1), F.lit(False)).alias("complete"))


def complete_pages(pages: DataFrame, what: str = "extract") -> DataFrame:
    """``pages``, or an error when a page is missing or came twice."""
    got = audit_pages(pages).first()
    if not got["complete"]:
        raise ValueError(f"{what}: {got['n_pages']} pages hold {got['n_records']} of {got['total_size']} records")
    return pages


def read_all_fields(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages of an all-fields extract (S7): one row per record, one text column per field that any record has.

    The fields are found by one aggregation over the records' keys (as many rows as there are fields), so a field that
    the service added since the last extract appears by itself; nested values are JSON text, ``attributes`` is dropped, and the
    columns stand in the order of their names.  An incomplete extract is an error."""
    page = T.StructType([T.StructField("totalSize", T.LongType()), T.StructField("done", T.BooleanType()),
                         T.StructField("records", T.ArrayType(T.StringType()))])
    pages = complete_pages(spark.read.schema(page).json(path), path)
    records = pages.select(F.explode("records").alias("r"))
    names = sorted(r[0] for r in records.select(F.explode(F.json_object_keys("r")).alias("k")).distinct().collect() if r[0] != "attributes")
    fields = F.from_json("r", T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return records.select(fields.alias("f")).select("f.*") if names else records.select().limit(0)
