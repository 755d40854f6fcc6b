"""Consent operators (C1-C6): consent table assembly, consents to create,
opt-outs to send, consent records for the load files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import iso_date, iso_utc, key_col
from .identity import party_type
from .joins import keep_matching, left_merge


def build_consent(cpc: DataFrame, cpe: DataFrame, acc: DataFrame, date_cols: Sequence[str] = (),
                  null_keys_match: bool = False) -> DataFrame:
    """Consent + e-mail contact point + account, party type, typed dates.

    Two left merges (J18): consent.ContactPointId -> contact point Id (clashing
    names get ``_cpe``), consent.PartyID__c -> account PersonContactId; the
    party type comes from the id prefix (F27); listed date columns become
    timestamps (unparsable text -> NULL)."""
    m = left_merge(cpc, cpe, "ContactPointId", "Id", suffix="_cpe", null_keys_match=null_keys_match)
    m = left_merge(m, acc, "PartyID__c", "PersonContactId", suffix="_acc", null_keys_match=null_keys_match)
    m = m.withColumn("PartyType", party_type("PartyID__c"))
    return m.withColumns({c: F.try_to_timestamp(F.col(c).cast("string")) for c in date_cols})


def missing_consents(optins: DataFrame, contact_points: DataFrame, consents: DataFrame,
                     email: str, cp_email: str, cp_id: str, consent_cp: str, consent_name: str,
                     name_col: str) -> DataFrame:
    """Consents to create (C3): opted-in addresses that have a contact point
    (J1) and no consent of that name yet (J10: anti join on two keys)."""
    with_cp = optins.join(contact_points.select(F.col(cp_email).alias(email), F.col(cp_id).alias("__cp")),
                          email, "inner")
    have = consents.select(F.col(consent_cp).alias("__cp"), F.col(consent_name).alias(name_col))
    return with_cp.join(have, ["__cp", name_col], "left_anti").withColumnRenamed("__cp", cp_id)


#: The consent of each property that sends newsletters.
PROPERTY_CONSENTS = {"FSV": "marketing_property_Velden", "FJE": "marketing_property_Jesolo",
                     "FBZ": "marketing_property_Bozen", "FMP": "marketing_property_Prague"}
#: The id prefix of persons and the name of the consent to all mail.
PERSON_PREFIX, CENTRAL_CONSENT = "003", "marketing_central"


def property_consents(optins: DataFrame, properties: DataFrame, contact_points: DataFrame, consents: DataFrame, source: str,
                      own_domain: str, names: Mapping[str, str] = PROPERTY_CONSENTS) -> DataFrame:
    """Property consents to create (C3): cpe_id, source, sf_property_id, consent_type.

    ``optins``: property_code, email, newsletter; ``properties``: code, sf_property_id; ``contact_points``: cpe_id, email;
    ``consents``: email, sf_property_id.  One row per opted-in address and property (newsletter 1, address known) and
    contact point of that address, unless the address is of ``own_domain`` or has a consent for that property.  A
    property without a target id stays, with a NULL id, for which no consent can exist; one without a consent name gets NULL."""
    a = (optins.where(F.col("email").isNotNull() & (F.col("newsletter") == 1)).select("property_code", "email")
         .join(properties.select(F.col("code").alias("property_code"), "sf_property_id"), "property_code", "left")
         .select("property_code", "email", "sf_property_id").distinct())
    a = a.where(~F.lower("email").endswith("@" + own_domain))
    a = a.join(consents.select("email", "sf_property_id"), ["email", "sf_property_id"], "left_anti")
    kind = F.coalesce(*[F.when(F.col("property_code") == k, F.lit(v)) for k, v in names.items()])
    return a.join(contact_points.select("cpe_id", "email"), "email").select(
        "cpe_id", F.lit(source).alias("source"), "sf_property_id", kind.alias("consent_type"))


def central_consents(optins: DataFrame, contact_points: DataFrame, consents: DataFrame, source: str,
                     name: str = CENTRAL_CONSENT) -> DataFrame:
    """Central consents to create (C3): source, cpe_id.  ``optins``: email; ``contact_points``: cpe_id, email, party_id;
    ``consents``: cpe_id, name.  A row per opt-in row and contact point of a person (``party_id`` begins with the
    persons' prefix) that has no consent of that name yet."""
    persons = contact_points.where(F.substring("party_id", 1, 3) == PERSON_PREFIX).select("cpe_id", "email")
    have = consents.where(F.col("name") == name).select("cpe_id")
    return (optins.select("email").join(persons.join(have, "cpe_id", "left_anti"), "email")
            .select(F.lit(source).alias("source"), "cpe_id"))


def optouts(unsubscribed: DataFrame, consents: DataFrame, email: str, consent_email: str, consent_id: str,
            consent_name: str, status: str, name: str, as_of: str, collation: str | None = None) -> DataFrame:
    """Opt-outs to send (C4): the distinct ids of the consents called ``name``
    whose *current* status is ``OptIn`` and whose address unsubscribed, with the end
    date ``as_of``.

    When somebody opted in again does not matter: the current status decides.
    The addresses act as a filter (semi join), so an address listed many times
    multiplies nothing; NULL addresses never match.  ``collation`` compares addresses, names and status."""
    wanted = consents.where((key_col(consents, consent_name, collation) == name) & (key_col(consents, status, collation) == "OptIn"))
    hit = keep_matching(wanted, unsubscribed.select(F.col(email).alias(consent_email)), [consent_email], collation=collation)
    return hit.select(consent_id).distinct().select(
        consent_id, F.lit(as_of).cast("date").alias("effective_to"), F.lit("OptOut").alias("status"))


def consent_records(df: DataFrame, key: str, captured: str, as_of: str, purpose: str = "Marketing",
                    source: str = "web") -> DataFrame:
    """Opted-in consent records in the target shape (C5): capture time as
    ISO-8601 UTC (``as_of`` when unknown), effective-from date, purpose."""
    cap = F.coalesce(F.col(captured), F.to_timestamp_ntz(F.lit(as_of)))
    return df.select(F.col(key), iso_utc(cap).alias("CaptureDate"), iso_date(cap).alias("EffectiveFrom"),
                     F.lit(purpose).alias("DataUsePurpose"), F.lit("OptIn").alias("PrivacyConsentStatus"),
                     F.lit(source).alias("CaptureSource"))
