"""Load-batch lifecycle (S16, S17, P2, P11-P13, B1-B10): field mapping, load
file lines per batch, request payloads, outcome reconciliation, processed
stamps and the archive step.

Sending batches to the remote service and polling it is not Spark work and
is not built; everything around it is: what goes into a batch, how it is
rendered, and how the returned outcome is folded back into the tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col


def map_fields(df: DataFrame, field_map: Mapping[str, Column | str], keep: Sequence[str] = ()) -> DataFrame:
    """Table-driven field mapping to target names (P2, B2): ``{target: source
    column or expression}``; ``keep`` passes control columns through."""
    return df.select(*[F.col(k) for k in keep], *[col(v).alias(k) for k, v in field_map.items()])


def blank_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL -> ``''`` for every listed field: an explicit "clear" (P12)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols})


def require(df: DataFrame, c: str, what: str | None = None) -> DataFrame:
    """Fail the job when a required key/id is missing (P13, J20): evaluated on
    the executors with ``raise_error``, no driver-side count."""
    msg = what or f"required field {c} is missing"
    return df.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(msg))).otherwise(F.col(c)))


def as_text(c: Column, dtype: T.DataType, python_bools: bool = True) -> Column:
    """Value as load-file text.  Booleans print as ``True``/``False`` like the
    reference's ``str()`` (``python_bools=False`` gives ``true``/``false``)."""
    if isinstance(dtype, T.BooleanType) and python_bools:
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    return c.cast("string")


def csv_escape(c: Column) -> Column:
    """Minimal CSV quoting: quote a field holding the separator, a quote or a
    line break, doubling inner quotes."""
    return F.when(c.rlike('[,"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))) \
        .otherwise(c)


def bulk_csv_lines(df: DataFrame, key: str, batch_col: str, seq_col: str, batch_size: int,
                   python_bools: bool = True) -> DataFrame:
    """Load-file lines per batch (S16, B4) as ``(batch, line_no, line)``.

    The header of a batch is the key followed by the sorted names of the
    fields that are non-NULL in at least one row *of that batch*; a row leaves
    a field empty when it is NULL there (indistinguishable from "clear" ``''``,
    as in the reference).  Line 0 is the header, data lines follow the
    sequence.  Field presence is one aggregation per batch, joined back; lines
    are built with ``concat_ws``, which skips the fields absent in the batch.
    """
    fields = sorted(c for c in df.columns if c not in (key, batch_col, seq_col))
    types = {f.name: f.dataType for f in df.schema.fields}
    pres = df.groupBy(batch_col).agg(*[F.max(F.col(c).isNotNull()).alias(f"__p{i}") for i, c in enumerate(fields)])
    header = pres.select(batch_col, F.lit(0).cast("long").alias("line_no"),
                         F.concat_ws(",", F.lit(key), *[F.when(F.col(f"__p{i}"), F.lit(c))
                                                        for i, c in enumerate(fields)]).alias("line"))
    text = {c: F.coalesce(csv_escape(as_text(F.col(c), types[c], python_bools)), F.lit("")) for c in fields}
    rows = df.join(pres, batch_col)
    line_no = (F.col(seq_col) - (F.col(batch_col) - 1) * batch_size).cast("long")
    body = rows.select(batch_col, line_no.alias("line_no"),
                       F.concat_ws(",", F.coalesce(csv_escape(as_text(F.col(key), types[key], python_bools)),
                                                   F.lit("")),
                                   *[F.when(F.col(f"__p{i}"), text[c]) for i, c in enumerate(fields)]).alias("line"))
    return header.unionByName(body)


def write_batch_files(lines: DataFrame, path: str, batch_col: str = "batch_no") -> None:
    """Write one text file set per batch (``batch_no=N/part-*``), lines in order."""
    (lines.repartition(batch_col).sortWithinPartitions(batch_col, "line_no")
     .select(batch_col, "line").write.mode("overwrite").partitionBy(batch_col).text(path))


def request_json(df: DataFrame, key: str, fields: Mapping[str, Column | str], object_type: str,
                 ref_prefix: str = "ref") -> DataFrame:
    """Row payload as JSON text (S17, P11, F28): an ``attributes`` header with
    type and reference id, then the fields; NULL fields are left out
    (``to_json`` drops them)."""
    attrs = F.struct(F.lit(object_type).alias("type"),
                     F.concat(F.lit(ref_prefix), F.col(key).cast("string")).alias("referenceId")).alias("attributes")
    body = F.struct(attrs, *[col(v).alias(k) for k, v in fields.items()])
    return df.select(F.col(key), F.to_json(body).alias("payload"))


def outcome(sent: DataFrame, failed: DataFrame, states: DataFrame, key: str, batch_col: str,
            state_col: str = "state", ok_states: Sequence[str] = ("JobComplete",)) -> DataFrame:
    """Reconcile a batch load (B5): a record failed when its id is in the
    failure results or its whole batch did not complete; the rest succeeded.
    Only completed batches count as success (an aborted job is a failure,
    SURVEY §8 Q18)."""
    f = failed.select(key).distinct().withColumn("__rec_failed", F.lit(True))
    s = states.select(batch_col, state_col)
    j = sent.join(s, batch_col, "left").join(f, key, "left")
    batch_bad = ~F.coalesce(F.col(state_col).isin(list(ok_states)), F.lit(False))
    reason = F.when(batch_bad, F.lit("batch_failed")).when(F.col("__rec_failed"), F.lit("record_failed"))
    return (j.withColumn("failure_reason", reason)
            .withColumn("outcome", F.when(reason.isNull(), F.lit("ok")).otherwise(F.lit("failed")))
            .drop("__rec_failed"))


def batch_summary(outcomes: DataFrame, batch_col: str) -> DataFrame:
    """Per batch: sent, succeeded, failed."""
    return outcomes.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n_sent"),
                                           F.count_if(F.col("outcome") == "ok").alias("n_ok"),
                                           F.count_if(F.col("outcome") == "failed").alias("n_failed"))


def outcome_by_values(sent: DataFrame, failures: DataFrame, cols: Sequence[str], batch_col: str,
                      order: Sequence[Column | str], n_col: str = "n_failed",
                      states: DataFrame | None = None, state_col: str = "state", ok_states: Sequence[str] = ("JobComplete",)) -> DataFrame:
    """Reconcile without ids (B6): the results only list failed value
    combinations; with ``n`` failures for a combination in a batch, the first
    ``n`` uploaded rows with those values (in upload ``order``) failed.

    With ``states`` (one row per batch) every row of a batch that did not complete, or has no state, failed.

    Failures are summed per combination first; only rows of combinations that failed are
    ranked, inside one batch (so a window holds at most a batch); all others are fine as they are."""
    keys = list(cols) + [batch_col]
    fails = failures.groupBy(*keys).agg(F.sum(n_col).alias("__n")).where(F.col("__n") > 0)
    w = Window.partitionBy(*keys).orderBy(*[col(o) for o in order])
    hit = sent.join(fails, keys).withColumn("__pos", F.row_number().over(w))
    hit = hit.withColumn("outcome", F.when(F.col("__pos") <= F.col("__n"), F.lit("failed")).otherwise(F.lit("ok")))
    fine = sent.join(fails, keys, "left_anti").withColumn("outcome", F.lit("ok"))
    out = fine.unionByName(hit.select(fine.columns))
    if states is None:
        return out
    done = states.where(F.col(state_col).isin(list(ok_states))).select(batch_col).distinct().withColumn("__done", F.lit(True))
    j = out.join(done, batch_col, "left")
    return j.withColumn("outcome", F.when(F.col("__done"), F.col("outcome")).otherwise(F.lit("failed"))).select(out.columns)


def claim(df: DataFrame, batch_id: str, operation: str, id_col: str, batch_col: str = "_batch_id",
          op_col: str = "_operation", excluded_col: str = "_excluded", processed_col: str = "_processed_at") -> DataFrame:
    """Open rows of a batch (B1): this batch and operation, not excluded, not
    processed yet, target id present.  Plain filters, pushed to the scan."""
    return df.where((F.col(batch_col) == batch_id) & (F.col(op_col) == operation)
                    & (F.coalesce(F.col(excluded_col), F.lit(0)) == 0) & F.col(processed_col).isNull()
                    & F.col(id_col).isNotNull())


def mark_processed(df: DataFrame, ok: DataFrame, key: str, as_of: str, processed_col: str = "_processed_at") -> DataFrame:
    """Stamp the rows that were loaded successfully (B7): a join with the
    distinct ok keys instead of a giant ``IN (...)`` list."""
    k = ok.select(key).distinct().withColumn("__ok", F.lit(True))
    j = df.join(k, key, "left")
    stamp = F.when(F.col("__ok") & F.col(processed_col).isNull(), F.to_timestamp_ntz(F.lit(as_of))) \
        .otherwise(F.col(processed_col))
    return j.withColumn(processed_col, stamp).drop("__ok")


def archive(work: DataFrame, batch_id: str, as_of: str, change_type: str, change_source: str,
            batch_col: str = "_batch_id") -> tuple[DataFrame, DataFrame]:
    """Archive a batch (B9): all its rows, processed or not, as history rows (with change type, source and version
    time), and the work table without them.  A blank batch id is an error.  ``sources.publish.archive_batch`` writes
    both, compares what was counted, and publishes them in one step."""
    if batch_id is None or not batch_id.strip():
        raise ValueError("archive: a batch id is required")
    own = F.col(batch_col) == batch_id
    hist = (work.where(own).withColumn("change_type", F.lit(change_type))
            .withColumn("change_source", F.lit(change_source))
            .withColumn("version_at", F.to_timestamp_ntz(F.lit(as_of))))
    return hist, work.where(~F.coalesce(own, F.lit(False)))


def sized_batches(df: DataFrame, order: Sequence[Column | str], key: str, size: Column, max_rows: int, max_bytes: int,
                  out: str = "batch_no", partitions: int | None = None) -> DataFrame:
    """Batch numbers bounded by rows and by bytes (W6, S16, B4), along a total ``order``; ``key`` is unique and not NULL.

    With running numbers of rows and bytes before a row, a batch ends where the rows pass a multiple of ``max_rows`` or the bytes
    one of ``max_bytes`` less the largest row, so a batch holds ``max_bytes`` at most.  A row larger than half of ``max_bytes``
    is an error, as batches would shrink to single rows.  The running bytes are made like the numbers
    (:func:`assign_sequence`): positions per range partition, sums per partition, offsets over one row per
    partition.  Nothing is sorted in one task; batches are numbered densely from 1 in the same way."""
    from .keys import assign_sequence, running_total
    slim = df.select(key, *[o for o in order if isinstance(o, str) and o != key], F.coalesce(size, F.lit(0)).cast("bigint").alias("__bytes"))
    largest = slim.agg(F.max("__bytes")).first()[0] or 0
    if 2 * largest > max_bytes:
        raise ValueError(f"a row of {largest} bytes; batches of {max_bytes} bytes need rows of half of that at most")
    slim = running_total(slim, order, "__bytes", "__before", "__seq", partitions)
    row_part = F.floor((F.col("__seq") - 1) / max_rows).cast("bigint")
    byte_part = F.floor(F.col("__before") / F.lit(max(1, max_bytes - largest))).cast("bigint")
    parts = slim.select(key, row_part.alias("__r"), byte_part.alias("__b"))
    numbers = assign_sequence(parts.select("__r", "__b").distinct(), ["__r", "__b"], 1, out)
    return df.join(parts.join(numbers, ["__r", "__b"]).select(key, out), key)


def percent_encoded(c: Column) -> Column:
    """The text percent-encoded but for letters, digits and ``_.-~`` (RFC 3986)."""
    out = F.url_encode(c)
    for old, new in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def json_part(method: str, url: Column | str, ref: str, body: Mapping[str, Column | str] | None = None) -> Column:
    """One sub-request as JSON text; fields of the body that are NULL are left out, as is a body that is None."""
    url = F.lit(url) if isinstance(url, str) else url
    fields = [F.lit(method).alias("method"), url.alias("url"), F.lit(ref).alias("referenceId")]
    if body is not None:
        fields.append(F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in body.items()]).alias("body"))
    return F.to_json(F.struct(*fields))


def chained_request(df: DataFrame, key: str, parts: Sequence[tuple[Column, Column | None]], all_or_none: bool = True) -> DataFrame:
    """Composite request of a varying list of sub-requests per row (S17): ``parts`` are (JSON text from :func:`json_part`,
    condition or None).  A part stands in a row's request where its condition holds; a row without any part gives no
    row.  Later parts refer to what earlier ones return by ``@{refName.field}``."""
    subs = F.array_compact(F.array(*[text if cond is None else F.when(cond, text) for text, cond in parts]))
    head = '{"allOrNone":' + ("true" if all_or_none else "false") + ',"compositeRequest":['
    payload = F.concat(F.lit(head), F.array_join("__subs", ","), F.lit("]}"))
    return df.select(F.col(key), subs.alias("__subs")).where(F.size("__subs") > 0).select(key, payload.alias("payload"))


#: API paths, names, purpose ids' columns and references of the consent chain.
API = "/services/data/v60.0"
ACCOUNT_QUERY = ("SELECT Id, PersonContactId, FirstName, LastName, PersonEmail, PersonBirthdate FROM Account WHERE Id = '", "' LIMIT 1")


def consent_chain(df: DataFrame, account: str, central: Column | str, hotel: Column | str, property_id: str, as_of: str,
                  source: str = "apaleo", with_central: Column | None = None, with_hotel: Column | None = None) -> DataFrame:
    """The chained consent request of an account (S17): read the account, create the individual and its e-mail contact point from what
    was read, then the central and the property consent on that point.  ``central`` and ``hotel`` are the purpose ids;
    the consents stand in the request where ``with_central`` / ``with_hotel`` hold (default: always).  (``account``, payload)."""
    record = "@{refAccount.records[0].%s}"
    day = F.lit(f"{as_of}T00:00:00.000Z")
    system = F.lit(source)
    consent = lambda name, purpose: {
        "Name": name, "ContactPointId": "@{refCPE.id}", "CaptureDate": day, "CaptureSource": "migration",
        "PrivacyConsentStatus": "OptIn", "DataUsePurposeId": purpose}
    url = F.concat(F.lit(f"{API}/query?q="), percent_encoded(F.concat(F.lit(ACCOUNT_QUERY[0]), F.col(account), F.lit(ACCOUNT_QUERY[1]))))
    parts = [
        (json_part("GET", url, "refAccount"), None),
        (json_part("POST", f"{API}/sobjects/Individual", "refIndividual", {
            "FirstName": record % "FirstName", "LastName": record % "LastName", "Contact__c": record % "PersonContactId",
            "SourceSystem__c": system}), None),
        (json_part("POST", f"{API}/sobjects/ContactPointEmail", "refCPE", {
            "ParentId": "@{refIndividual.id}", "Contact__c": record % "PersonContactId", "EmailAddress": record % "PersonEmail",
            "ActiveFromDate": day, "SourceSystem__c": system}), None),
        (json_part("POST", f"{API}/sobjects/ContactPointConsent", "refConsentCentral", {
            **consent("marketing_central", col(central)), "EffectiveFrom": day, "SourceSystem__c": system}), with_central),
        (json_part("POST", f"{API}/sobjects/ContactPointConsent", "refConsentHotel", {
            **consent("marketing_hotel", col(hotel)), "Property__c": F.col(property_id), "EffectiveFrom": day, "SourceSystem__c": system}), with_hotel),
    ]
    return chained_request(df.where(F.col(account).isNotNull()), account, parts)


def composite_request(df: DataFrame, key: str, parts: Sequence[tuple[str, str, str, Mapping[str, Column | str]]],
                      all_or_none: bool = True) -> DataFrame:
    """Composite request payload per row (S17): ``{"allOrNone": .., "compositeRequest": [sub, ...]}``
    where each sub-request is ``(method, url, referenceId, body)``.

    Sub-request bodies have different shapes, so each is rendered with
    ``to_json`` on its own (NULL fields left out) and the array is assembled
    as text; the result is valid JSON."""
    subs = []
    for method, url, ref, body in parts:
        b = F.struct(*[col(v).alias(k) for k, v in body.items()])
        subs.append(F.to_json(F.struct(F.lit(method).alias("method"), F.lit(url).alias("url"),
                                       F.lit(ref).alias("referenceId"), b.alias("body"))))
    head = '{"allOrNone":' + ("true" if all_or_none else "false") + ',"compositeRequest":['
    return df.select(F.col(key), F.concat(F.lit(head), F.concat_ws(",", *subs), F.lit("]}")).alias("payload"))
