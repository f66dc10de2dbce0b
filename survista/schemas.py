"""Declared schemas of the native form / record store (inferred from use).

Every id is an upper-case GUID string. Loading with a declared schema avoids
inference passes over large inputs and pins types for the parity rules.
"""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, StringType, StructField,
                               StructType, TimestampType)

_TYPES = {"string": StringType(), "int": IntegerType(), "double": DoubleType(), "boolean": BooleanType(),
          "date": DateType(), "timestamp": TimestampType()}


def _ddl(text: str) -> StructType:
    """'name type, name type, ...' -> StructType (flat schemas only)."""
    fields = []
    for part in text.split(","):
        name, typ = part.split()
        fields.append(StructField(name, _TYPES[typ], True))
    return StructType(fields)


S = "string"
TABLES: dict[str, StructType] = {
    "org_unit": _ddl(f"id {S}, name {S}, number {S}"),
    "user_profile": _ddl(f"id {S}, user_name {S}"),
    "user_profile_org_unit": _ddl(f"user_profile_id {S}, org_unit_id {S}"),
    "roster_year": _ddl(f"id {S}, start_year int, start_date date, end_date date"),
    "mon_program": _ddl(f"id {S}, display_name {S}"),
    "mon_location": _ddl(f"id {S}, program_id {S}, display_name {S}, sequence int"),
    "mon_submission_type": _ddl(f"id {S}, name {S}, location_id {S}, form_template_id {S}"),
    "mon_submission_mode": _ddl(f"id {S}, name {S}, submission_type_id {S}"),
    "mon_submissions": _ddl(
        f"id {S}, org_unit_id {S}, roster_year_id {S}, submission_type_id {S}, "
        f"submission_mode_id {S}, record_set_id {S}, started_date timestamp, "
        f"closed_date timestamp, deleted_date timestamp, "
        f"reliability_check_of_submissions_id {S}"),
    "mon_submission_record": _ddl(
        f"id {S}, submissions_id {S}, record_selection_id {S}, sequence_number int"),
    "mon_submission_record_form": _ddl(f"id {S}, submission_record_id {S}"),
    "mon_record_set": _ddl(f"id {S}, name {S}, sampled_from_id {S}"),
    "mon_record": _ddl(f"id {S}, record_set_id {S}, search_key {S}"),
    "mon_record_selection": _ddl(
        f"id {S}, record_id {S}, record_set_id {S}, excluded_date timestamp"),
    "mon_record_attribute": _ddl(f"id {S}, name {S}, record_set_id {S}, sequence_number int"),
    "mon_record_attribute_value": _ddl(f"record_id {S}, attribute_id {S}, value {S}"),
    "form_template": _ddl(f"id {S}, name {S}"),
    "form_template_layout": _ddl(
        f"id {S}, template_id {S}, control_id {S}, parent_id {S}, sequence int"),
    "form_template_control": _ddl(f"id {S}, type_id {S}, is_repeatable boolean"),
    "form_template_control_type": _ddl(f"id {S}, name {S}"),
    "form_template_control_property": _ddl(f"control_id {S}, name {S}, value {S}"),
    "form_template_input_item": _ddl(
        f"id {S}, input_area_id {S}, type_id {S}, sequence int, code {S}, label {S}, "
        f"report_label {S}, report_weight double"),
    "form_template_input_item_type": _ddl(f"id {S}, name {S}"),
    "form_template_input_select_field_option": _ddl(
        f"id {S}, input_item_id {S}, label {S}, report_label {S}, sequence int, "
        f"deleted_date timestamp"),
    "form_instance": _ddl(f"id {S}, template_id {S}"),
    "form_instance_interval": _ddl(f"id {S}, instance_id {S}"),
    "form_input_value": _ddl(f"id {S}, interval_id {S}, input_field_id {S}"),
    "form_input_text_value": _ddl(f"id {S}, value {S}"),
    "form_input_single_select_value": _ddl(f"id {S}, selected_option_id {S}"),
    "form_input_date_value": _ddl(f"id {S}, value timestamp"),
    "form_input_flag_value": _ddl(f"id {S}, value boolean"),
    "mon_submission_area": _ddl(
        f"id {S}, label {S}, form_template_control_id {S}, submission_type_id {S}, "
        f"sequence int"),
    "mon_submission_item": _ddl(
        f"id {S}, submission_area_id {S}, label {S}, form_template_input_item_id {S}, "
        f"sequence int"),
    "prg_status": _ddl(
        f"state_code {S}, name {S}, program_id {S}, is_exit boolean, deleted_date timestamp"),
    "enum_value": _ddl(f"state_code {S}, display_value {S}, type {S}, is_active boolean"),
}
