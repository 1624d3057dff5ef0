"""Explicit schemas and column contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# the column contracts of the interchange files, in their order
OUTPUT_36 = (
    "lead_id pos_id match_result similarity_score winning_set match_type primary_transaction matched_by "
    "matching_comments closed_existing_flag account_number transaction_count business_name_transaction "
    "membership_number warehouse_number sales_reference_id fiscal_year_transaction fiscal_period_transaction week "
    "shop_type bd_industry order_amount industry_description first_name last_name address_line_one address_line_two "
    "city state zip_code email phone u_matched_lead_number u_order_amount u_order_amount_rounded updated_date"
).split()
INTERNAL_25 = (
    "match_run_id lead_id pos_id warehouse_number match_type lifecycle_state primary_transaction final_score "
    "combined_field_score full_address_score business_name_score email_boost phone_boost winning_set embedding_model "
    "lead_fiscal_year lead_fiscal_period lead_week pos_fiscal_year pos_fiscal_period pos_week lead_business_name "
    "pos_business_name order_amount created_date"
).split()
DEBUG_13 = (
    "lead_id pos_id warehouse_number expected_relation combined_similarity name_score address_score email_boost "
    "phone_boost final_score winning_set decision reason"
).split()
TYPES = {
    "similarity_score": "double", "order_amount": "double", "u_order_amount": "double", "u_order_amount_rounded": "double",
    "winning_set": "int", "transaction_count": "int", "fiscal_year_transaction": "int", "fiscal_period_transaction": "int",
    "week": "int", "primary_transaction": "boolean", "closed_existing_flag": "boolean", "warehouse_number": "int",
    "updated_date": "timestamp",
}
RENAMES = {"oms_company": "oms_company_name", "oms_company_2": "oms2_company_name"}


def missing(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n not in df.columns]


def validate_contract(df: DataFrame, names: list[str]) -> None:
    """The columns, in their order; extra columns may follow. ValueError names what is wrong."""
    if gone := missing(df, names):
        raise ValueError(f"columns are missing: {gone}")
    if list(df.columns[: len(names)]) != list(names):
        raise ValueError("columns are out of order")


def conform(df: DataFrame, names: list[str]) -> DataFrame:
    """The contract's columns in its order; those that df lacks are null."""
    return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast(TYPES.get(n, "string")).alias(n) for n in names])
