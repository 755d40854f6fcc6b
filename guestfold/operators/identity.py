"""Identity resolution and enrichment (D1-D21): survivors, propagation of
cluster ids, matching across systems, loyalty picks, target-id attachment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, key_col, money_sum
from .keys import pick_one
from .report import string_agg


def latest_before(df: DataFrame, key: str, ts: str, as_of: str, tie: str) -> DataFrame:
    """Latest row per key at or before ``as_of`` (D4, P10): filter then W1."""
    cut = F.to_timestamp_ntz(F.lit(as_of)) if len(as_of) > 10 else F.to_timestamp_ntz(F.lit(as_of + " 00:00:00"))
    return pick_one(df.where(F.col(ts) <= cut), [key], [F.col(ts).desc(), F.col(tie).desc()])


def shared_identity(df: DataFrame, email: str, birth: str, name_cols: Sequence[str]) -> DataFrame:
    """Same e-mail and birth date under several names (D14: G3/G4/G9/G10).

    Profiles combine per name first; names are only gathered for the groups that have several, so a group
    holds its distinct names and never its profiles."""
    name = F.concat(*sum([[F.coalesce(F.col(c), F.lit(""))] + ([F.lit(" ")] if i < len(name_cols) - 1 else [])
                          for i, c in enumerate(name_cols)], []))
    base = df.where(F.col(email).isNotNull() & (F.trim(F.col(email)) != "") & F.col(birth).isNotNull()) \
        .select(F.lower(F.trim(F.col(email))).alias("email_key"), F.col(birth).alias(birth), name.alias("__name"))
    per_name = base.groupBy("email_key", birth, "__name").agg(F.count(F.lit(1)).alias("__n"))
    several = per_name.groupBy("email_key", birth).agg(F.sum("__n").alias("n_profiles"), F.count(F.lit(1)).alias("n_names")) \
        .where(F.col("n_names") > 1)
    names = per_name.join(several.select("email_key", birth), ["email_key", birth], "left_semi") \
        .groupBy("email_key", birth).agg(string_agg("__name", "|").alias("names"))
    return several.join(names, ["email_key", birth])


def loyalty_pick(df: DataFrame, key: str, ts: str, value: str, tie: str, floor: str = "1900-01-01") -> DataFrame:
    """Loyalty row per member (D5): latest transaction first (a missing date
    counts as ``floor``), then the most points (missing = 0), then the tie
    column descending.  The "forced" variant of the scripts is the same pick
    over a subset (``keep_matching`` with the mapping list, no status filter)
    applied with ``fill_from``, i.e. only where the member id is still empty."""
    last = F.coalesce(F.col(ts), F.to_timestamp_ntz(F.lit(floor + " 00:00:00")))
    d = df.withColumn("last_ts", last)
    return pick_one(d, [key], [F.col("last_ts").desc(), F.coalesce(F.col(value), F.lit(0)).desc(), F.col(tie).desc()])


def member_number(c, offset: int) -> Column:
    """New member number = offset + cluster id."""
    return (col(c) + F.lit(offset)).cast("bigint")


#: Id prefix (first three characters) -> entity type.
ID_PREFIX_TYPES = {"001": "Account", "003": "Contact", "00Q": "Lead"}


def party_type(c) -> Column:
    """Entity type from the three-character id prefix; unknown prefix -> NULL."""
    from ..functions.columns import literal_map
    return F.try_element_at(literal_map(ID_PREFIX_TYPES), F.substring(col(c), 1, 3))


def match_rules(a: DataFrame, b: DataFrame, a_id: str, b_id: str,
                rules: Sequence[tuple[Sequence[str], Sequence[str]]], match_col: str = "match_key",
                rule_col: str = "rule", collation: str | None = None) -> DataFrame:
    """Match rows of ``a`` to ``b`` by an ordered list of key rules.

    The first rule that finds a partner wins, and within a rule the smallest
    ``b`` id.  So each rule only needs ``min(b_id)`` per rule key: ``b`` is
    aggregated to one row per key (partial aggregation, safe for hot keys)
    before the join, and the join is many-to-one; no key group ever emits all
    of its pairs.  Candidates of all rules are unioned and the lowest rule
    number is picked per ``a`` row.  Equal to running the rules in order on
    the still unmatched rows.  ``collation`` compares string keys of the rules."""
    cands = None
    for i, (ak, bk) in enumerate(rules, start=1):
        bb = (b.groupBy(*[key_col(b, k, collation).alias(f"__b{j}") for j, k in enumerate(bk)])
              .agg(F.min(b_id).alias(match_col)))
        cond = [key_col(a, k, collation) == bb[f"__b{j}"] for j, k in enumerate(ak)]
        c = a.join(bb, cond, "inner").select(F.col(a_id), F.col(match_col), F.lit(i).alias(rule_col))
        cands = c if cands is None else cands.unionByName(c)
    return pick_one(cands, [a_id], [rule_col, match_col])


#: Fixed value: the quality bucket whose rows match by list id and e-mail.
MATCH_BUCKET = "2_has_lastname_and_email"


def match_by_list(res: DataFrame, source_rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """Open reservations matched by list id, e-mail and quality (D9): ``res`` columns with the profile's target ids.

    ``res``: reservation_id, email, data_quality_bucket, sf_person_contact_id, sf_reservation_id, sf_property_id, _excluded;
    ``source_rows``: pms_reservation_id, list_id, is_duplicate; ``profiles``: list_id, email, sf_contact_id, sf_account_id.
    Of a reservation that has no target ids, is not excluded and has a property, the profile of its source row's list with the
    same e-mail and a target contact gives contact and account.  Of several such profiles the least contact id counts."""
    todo = res.where(F.col("sf_person_contact_id").isNull() & F.col("sf_reservation_id").isNull() & (F.col("_excluded") == 0)
                     & F.col("sf_property_id").isNotNull() & (F.col("data_quality_bucket") == MATCH_BUCKET))
    lists = source_rows.where(F.col("is_duplicate") == 0).select(F.col("pms_reservation_id").alias("reservation_id"), "list_id").distinct()
    best = (profiles.where(F.col("sf_contact_id").isNotNull()).groupBy("list_id", "email")
            .agg(F.min(F.struct("sf_contact_id", "sf_account_id")).alias("__p")))
    hit = todo.join(lists, "reservation_id").join(best, ["list_id", "email"])
    one = hit.groupBy("reservation_id").agg(F.min("__p").alias("__p"))
    return _with_ids(todo, one)


def match_by_cluster(res: DataFrame, accounts: DataFrame, targets: DataFrame) -> DataFrame:
    """Open reservations matched by the cluster of their account (D9): ``res`` columns with the target's ids.

    ``accounts``: source_id, cluster_id; ``targets``: cluster_id, sf_contact_id, sf_account_id.  Reservations without a
    target id that are not excluded; of several targets the least contact id counts."""
    todo = res.where(F.col("sf_reservation_id").isNull() & (F.col("_excluded") == 0))
    best = targets.groupBy("cluster_id").agg(F.min(F.struct("sf_contact_id", "sf_account_id")).alias("__p"))
    hit = accounts.select(F.col("source_id").alias("reservation_id"), "cluster_id").distinct().join(best, "cluster_id")
    return _with_ids(todo, hit.groupBy("reservation_id").agg(F.min("__p").alias("__p")))


def _with_ids(res: DataFrame, found: DataFrame) -> DataFrame:
    ids = {"sf_person_contact_id": "sf_contact_id", "sf_person_account_id": "sf_account_id"}
    j = res.drop(*ids).join(found, "reservation_id")
    return j.withColumns({k: F.col(f"__p.{v}") for k, v in ids.items()}).drop("__p")


def backfill_unique(df: DataFrame, links: DataFrame, key: tuple[str, str] | str, val: str, out: str,
                    collation: str | None = None) -> DataFrame:
    """Fill ``out`` from the linked rows only when all of them agree on one
    value (D3): keep keys whose least and greatest value are equal (one partial
    aggregation, no distinct count), then fill only where ``out`` is still NULL (M4).

    ``collation`` compares string keys, and text values that it holds equal agree: the greatest as written is filled in."""
    lk, rk = (key, key) if isinstance(key, str) else key
    if collation:
        known = links.where(F.col(val).isNotNull())
        v = key_col(known, val, collation)
        agg = (known.groupBy(key_col(known, rk, collation).alias("__k"))
               .agg(F.max(val).alias("__v"), F.max(v).alias("__hi"), F.min(v).alias("__lo")).where(F.col("__hi") == F.col("__lo")).drop("__hi", "__lo"))
        j = df.join(agg, key_col(df, lk, collation) == agg["__k"], "left")
        return j.withColumn(out, F.coalesce(F.col(out), F.col("__v"))).drop("__v", "__k")
    agg = (links.where(F.col(val).isNotNull()).groupBy(F.col(rk).alias(lk))
           .agg(F.max(val).alias("__v"), F.min(val).alias("__lo"))
           .where(F.col("__v") == F.col("__lo")).drop("__lo"))
    j = df.join(agg, lk, "left")
    return j.withColumn(out, F.coalesce(F.col(out), F.col("__v"))).drop("__v")


def relate(df: DataFrame, id_map: DataFrame, key: tuple[str, str], id_col: str) -> DataFrame:
    """Relate rows to the target id of their cluster through the id table.

    Rows without an id are dropped (inner join), never written with NULL."""
    lk, rk = key
    m = id_map.groupBy(F.col(rk).alias(lk)).agg(F.min(id_col).alias(id_col))  # the least id of a cluster
    return df.join(m, lk, "inner")


def name_in_email(df: DataFrame, email: str, last_name: str) -> DataFrame:
    """Rows whose last name occurs in the e-mail local part (D15).  A plain
    substring test, so ``%``/``_`` in names cannot act as wildcards; blank
    names never match."""
    local = F.substring_index(F.lower(F.trim(F.col(email))), "@", 1)
    ln = F.lower(F.trim(F.col(last_name)))
    return df.where(F.col(last_name).isNotNull() & (F.trim(F.col(last_name)) != "") & local.contains(ln))


def high_value(df: DataFrame, active: DataFrame, key: str, currency: str, amount: str, minimum: float) -> DataFrame:
    """High-value guests (D17): revenue per key *and currency* (amounts in
    different currencies are never added) over ``minimum``, restricted to keys
    that are active (semi join)."""
    act = active.select(key).distinct()
    rev = (df.join(act, key, "left_semi").groupBy(key, currency)
           .agg(money_sum(amount, 2).alias("__rev")))
    return rev.where(F.col("__rev") > F.lit(minimum)).select(key, currency, F.col("__rev").cast("double").alias("revenue"))


def classify_import(df: DataFrame, target: DataFrame, key: tuple[str, str], name: tuple[str, str],
                    op_col: str = "operation", reason_col: str = "conflict_reason", collation: str | None = None) -> DataFrame:
    """Import operation per row (D11): ``create`` without a target match, ``none``
    with a reason when the name of *any* matching target differs (J14), else
    ``update``.  A NULL name on either side differs from nothing (SQL ``<>``).

    The names of a key's targets reduce to their least and greatest, which
    tells whether one of them differs, without a row per target.  ``collation`` compares string keys and names."""
    lk, rk = key
    ln, rn = name
    theirs, own = key_col(target, rn, collation), key_col(df, ln, collation)
    t = (target.where(F.col(rk).isNotNull()).groupBy(key_col(target, rk, collation).alias("__tk"))
         .agg(F.min(theirs).alias("__lo"), F.max(theirs).alias("__hi")))
    j = df.join(t, key_col(df, lk, collation) == t["__tk"], "left")
    differs = F.coalesce((F.col("__lo") != own) | (F.col("__hi") != own), F.lit(False))
    op = F.when(F.col("__tk").isNull(), F.lit("create")).when(differs, F.lit("none")).otherwise(F.lit("update"))
    reason = F.when(F.col("__tk").isNotNull() & differs, F.lit("name_conflict"))
    return j.withColumn(op_col, op).withColumn(reason_col, reason).drop("__tk", "__lo", "__hi")


def attach_ids(df: DataFrame, accounts: DataFrame, key: tuple[str, str], cols: Sequence[str],
               id_col: str, person_only: bool = True, order: Sequence[Column | str] | None = None,
               collation: str | None = None) -> DataFrame:
    """Attach target ids by a matching key (D10, D20).  Accounts are reduced to
    one row per key (``order``, default the id) before the left join; with
    ``person_only`` ids are attached only when the id prefix marks a person
    account (F27).  ``collation`` compares string keys."""
    lk, rk = key
    acc = pick_one(accounts, [rk], order or [id_col], collation=collation)
    acc = acc.select(key_col(acc, rk, collation).alias("__k"), *[F.col(c) for c in cols])
    j = df.join(acc, key_col(df, lk, collation) == acc["__k"], "left").drop("__k")
    if person_only:
        ok = party_type(F.col(id_col)) == "Account"
        j = j.withColumns({c: F.when(ok, F.col(c)) for c in cols})
    return j


def enrolment_date(*candidates) -> Column:
    """Enrolment date fallback (D6): the first known of the candidates, e.g.
    programme start, first transaction, record creation."""
    return F.coalesce(*[F.to_date(col(c)) for c in candidates])


#: Source systems by survivor priority (lower wins; others rank 2).
SURVIVOR_SOURCE_RANK = {"gms": 0, "protel": 1, "apaleo": 1}
#: Matching-rule bins by priority (lower wins; others rank 2).
SURVIVOR_RULE_RANK = {1: 0, 0: 1}


def survivors(df: DataFrame, cluster: str = "cluster_id", source: str = "source", source_id: str = "source_id",
              complete: str = "complete_fields", rule_bin: str = "_rule_bin",
              required: tuple[str, ...] = ("cluster_first_name", "cluster_last_name", "cluster_email"),
              rule_bins: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Survivor record per identity cluster (D1): among candidates with a
    cluster id, the required cluster name/e-mail fields and an accepted rule
    bin, the best source system wins, then the most complete record, then the
    better rule bin, then source and source id (a total order).  The clusters
    themselves come from upstream."""
    from ..functions.columns import literal_map
    src_rank = F.coalesce(F.try_element_at(literal_map({k: str(v) for k, v in SURVIVOR_SOURCE_RANK.items()}),
                                           F.col(source)).cast("int"), F.lit(2))
    bin_rank = F.coalesce(F.try_element_at(F.create_map(*sum([[F.lit(k), F.lit(v)] for k, v in SURVIVOR_RULE_RANK.items()], [])),
                                           F.col(rule_bin)), F.lit(2))
    cand = df.where(F.col(cluster).isNotNull() & F.col(rule_bin).isin(list(rule_bins)))
    for r in required:
        cand = cand.where(F.col(r).isNotNull())
    return pick_one(cand, [cluster], [src_rank, F.col(complete).desc(), bin_rank, F.col(source).asc(), F.col(source_id).asc()])


#: Import column and the profile column it comes from.
IMPORT_COLUMNS = {
    "cluster_id": "cluster_id", "source_id": "list_id", "clean_first_name": "fname", "clean_last_name": "lname", "clean_email": "email",
    "clean_birth_date": "birthday", "salutation": "salutation", "gender": "gender", "address": "address", "city": "city",
    "postal_code": "zip", "country": "country", "nationality": "citizenship", "language": "language_code",
    "legacy_member_number": "member_id", "member_number_new": "member_number_new", "member_tier": "member_tier",
    "enrollment_date": "enrollment_date", "sf_contact_id": "sf_contact_id", "sf_account_id": "sf_account_id", "sf_member_id": "sf_member_id",
    "sf_cpe_id": "sf_cpe_id", "sf_entra_id": "sf_entra_id", "central_consent": "central_consent", "is_investor": "is_investor",
}


def select_import(profiles: DataFrame, source: str = "gms", investors: bool = False) -> DataFrame:
    """Profiles to import (D19) under the import's column names: with a usable name and no target
    contact yet, and either an allowed address with an opt-in or a member tier, or (``investors``) any investor.
    The phone is the first of cell, home and office; the birth place is unknown.  Columns that the
    profiles lack are NULL."""
    from ..functions.cleaning import first_phone
    have = set(profiles.columns)
    get = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    new = (F.col("missing_name") == 0) & F.col("sf_contact_id").isNull()
    target = F.col("is_investor") == 1 if investors else \
        (F.col("exclude_email") == 0) & ((F.col("current_opt_in") == "Yes") | F.col("member_tier").isNotNull())
    return profiles.where(new & target).select(
        *[get(src).alias(out) for out, src in IMPORT_COLUMNS.items()], F.lit(source).alias("source"),
        first_phone(get("cell_phone"), get("home_phone"), get("office_phone")).alias("phone"), F.lit(None).cast("string").alias("birth_place"))


def member_export(accounts: DataFrame) -> DataFrame:
    """Members with a target contact, under the directory's column names."""
    return accounts.where(F.col("member_tier").isNotNull() & F.col("sf_contact_id").isNotNull()).select(
        "cluster_id", F.col("clean_first_name").alias("givenName"), F.col("clean_last_name").alias("surname"),
        F.col("clean_email").alias("email"), F.col("member_number_new").alias("member_number"))


def assemble_import(staging: DataFrame, points: DataFrame, accounts: DataFrame, members: DataFrame, fields: Mapping[str, Column],
                    uid: str, batch_id: str, source: str, skip: Sequence[str] = (), operation: str = "update",
                    id_prefix: str = "003", email: str = "email", fname: str = "fname", collation: str | None = None) -> DataFrame:
    """Import rows for accounts that exist (D12): staging rows with the ids of their e-mail, account and member records.

    ``points``: Id, EmailAddress, PartyID__c; ``accounts``: Id, PersonContactId, PersonEmail, FirstName; ``members``: Id, ContactId.
    A staging row is taken with each contact point of its e-mail whose party id starts with ``id_prefix``, each account of that party
    with the same e-mail and first name, and each of the party's members; equal results come once.  Ids in ``skip`` stay out, and
    rows without an id with them where ``skip`` isn't empty (SQL ``NOT IN``).  ``fields`` names the target columns that come from
    staging.  All rules on one side run before the joins; ``collation`` compares e-mails and names without letter case."""
    if not (batch_id or "").strip():
        raise ValueError("an import needs a batch id")
    st = staging.where(~F.col(uid).isin(list(skip))) if skip else staging
    st = st.select(key_col(st, email, collation).alias("__mail"), key_col(st, fname, collation).alias("__fname"), F.col(uid).alias("external_id"),
                   *[c.alias(n) for n, c in fields.items()]).where("__mail is not null and __fname is not null")
    cp = points.where(F.substring("PartyID__c", 1, len(id_prefix)) == id_prefix)
    cp = cp.select(key_col(cp, "EmailAddress", collation).alias("__mail"), F.col("PartyID__c").alias("__party"), F.col("Id").alias("sf_cp_email_id"))
    ac = accounts.select(key_col(accounts, "PersonEmail", collation).alias("__mail"), key_col(accounts, "FirstName", collation).alias("__fname"),
                         F.col("PersonContactId").alias("__party"), F.col("Id").alias("sf_account_id"))
    me = members.select(F.col("ContactId").alias("__party"), F.col("Id").alias("sf_loyalty_member_id")).distinct()
    own = st.distinct().join(cp.distinct(), "__mail").join(ac.distinct(), ["__mail", "__fname", "__party"]).join(me, "__party")
    return own.select(F.lit(operation).alias("_operation"), F.lit(batch_id).alias("_batch_id"), "sf_account_id",
                      F.col("__party").alias("sf_person_contact_id"), "sf_loyalty_member_id", "sf_cp_email_id",
                      F.lit(source).alias("source"), "external_id", *fields).distinct()
