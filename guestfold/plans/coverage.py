"""Which SURVEY §2 operator IDs each registered query exercises (mirrors §2.15)."""

QUERY_IDS = {
    "survivor_per_key": "W1 D1", "latest_before": "D4 P10", "flag_duplicates": "W2", "drop_all_duplicated": "M7 J16",
    "dominant_value": "W4 N6", "assign_sequence": "W5", "assign_batches": "W5 W6", "group_size_band": "W7",
    "share_of_total": "W3", "domain_share": "W3 K9", "flag_exists": "M3 J6 C2", "in_subquery": "J7 D16",
    "anti_missing": "J8 J9 D13", "anti_multi_key": "J10 C3", "semi_of_anti": "J11", "interval_exclusion": "J12 R9",
    "conflict_pairs": "J14", "match_rules": "J3 D8 D9", "backfill_unique": "D3", "lookup_one": "J21",
    "consent_merge": "J18 C1 F27", "update_from": "M2 R5", "fill_from": "M4 R7", "upsert_actions": "M8 M9 M11",
    "change_counts": "M10 P9", "version_pairs": "U3 P9", "insert_ignore": "S14", "replace_slice": "M5",
    "folio_revenue": "R2 G5 G16", "fold_events": "R3 R4", "commercial_report": "K4 U1 F15 S15",
    "occupancy_kpis": "K3", "occupancy_daily": "K1 U1 J6 G2", "kpi_long": "K2 K3", "star_join": "J5", "unmapped_amounts": "K6 J9",
    "fill_rates": "K7", "ratio_by_period": "G15 K8", "level_totals": "G12 C6", "string_agg": "G9",
    "shared_identity": "D14 G3 G4 G9 G10", "length_profile": "G17 F8", "object_counts": "U2 K11",
    "year_month_counts": "K10 G11", "top_groups": "O1 O2 G1", "two_system_codes": "K13 G3",
    "high_value": "D17", "loyalty_pick": "D5 D7", "classify_import": "D11", "relate": "D18 J1",
    "attach_sso": "D20 D10", "exclusion_reasons": "R8", "preference_tags": "R12", "import_sets": "R10",
    "status_maps": "N21 F12 F26", "quality_bucket": "N22", "trim_email_domain": "N1 N2 F2 F6",
    "email_flags": "N13 N14", "document_emails": "N14", "title_case": "N3", "salutation": "N4", "gender": "N5",
    "infer_gender": "N6 W4 M2", "country_codes": "N7 N8", "code_review": "N9", "language_default": "N10",
    "load_contact": "B2", "load_contact_update": "B2", "load_member": "B2 B3", "load_member_update": "B2", "load_reservation": "B2 B3 P13",
    "load_consent": "B2", "load_optout": "B2", "load_journal": "B2", "load_preference": "B2 R12", "load_property": "B2 B3",
    "load_rate_code": "B2 B3", "normalise_reservations": "N21", "lookup_strict": "J20", "build_consent": "C1 J18", "citizenship_codes": "N8", "citizenship_list": "N8",
    "hotel_occupancy": "K1 J6 U1", "hotel_day_kpis": "K3", "hotel_commercial": "K4 U1", "reservation_revenue": "R2 G16",
    "select_import": "D19 N16", "member_export": "D21", "split_property": "R6", "correct_rates": "K12 S13", "reservation_preferences": "R12",
    "since_switch": "J13", "inside_window": "J12", "sparse_records": "P11", "recode_names": "F11", "write_types": "S9 N17 S18", "enrolment_dates": "D6",
    "language_codes": "N10", "infer_salutation": "N6 W4", "reservation_exclusions": "R8",
    "name_flags": "N11 N12 N15", "phones": "N16", "birth_bounds": "N18 F16", "age_years": "F17",
    "repair_encoding": "N20", "strip_suffix_fit": "N17 N19", "name_in_email": "D15",
    "cleaning_report": "N23 G6 G7", "iso_dates": "F22 F23 F24 F25", "payload_json": "S17 F28",
    "composite_payload": "S17 R12", "bulk_csv_lines": "S16 B2 B4", "batch_outcome": "B5",
    "batch_summary": "B8", "outcome_by_values": "B6", "claim_mark_archive": "B1 B7 B9", "archive_counts": "B9", "archive_swap": "B9 S12 M5", "all_fields_extract": "S6 S7", "day_kpis_function": "K3 S15", "reservation_view": "S15 R13",
    "sized_batches": "W6 S16 B4", "composite_chain": "S17", "upsert_partitioned": "M8 M9 M5", "property_consents": "C3", "central_consents": "C3",
    "match_by_list": "D9", "match_by_cluster": "D9", "property_ids": "R5", "failure_files": "B5 B8",
    "filters": "P3 P4 P5 P10", "filters_text": "P6 P7 P8", "projection": "P1 P2 P12 P14 R1",
    "standardise_reservations": "R1 R5 F13", "recover_email": "R7", "required_guard": "P13 J20",
    "join_kinds": "J2 J4 J15 J17 J19", "agg_kinds": "G2 G4 G8 G13 G14",
    "scalar_text": "F1 F3 F4 F5 F7 F9 F10 F29", "scalar_dates": "F13 F14 F18 F19 F20 F21", "offset_rows": "O3",
    "update_where": "M1 M13 R11", "delete_matching": "M6", "add_rename_cast": "M12",
    "propagate_keys": "D2", "build_import": "D12", "import_assembly": "D12", "contact_report": "N23", "contact_findings": "N23", "optouts": "C4", "consent_records": "C5",
    "missing_consents": "C3", "conditional_nights": "K5 R13", "parameterised_query": "S1 S15",
    "backup_copy": "S5 S11 S12", "rejects_and_maps": "S18 S19 B10", "csv_load": "S2 S3 S4",
    "object_pages": "S6", "object_extract": "S7", "identity_survivors": "D1 W1", "save_modes": "S8 S9 S10", "anti_events_users": "J7 J8",
}
