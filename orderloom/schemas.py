"""Columns and types of the source tables and of the wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = "decimal(18,2)"

# Source tables with the columns the engine reads. DATETIME columns have no
# zone at the source, hence timestamp_ntz.
SOURCE_TABLES = {
    "sale_order_items": f"""id long, sale_order_id long, itemParentable_type string,
        itemParentable_id long, saleable_type string, saleable_id long,
        discount_percentage {MONEY}, mrp {MONEY}, unit_price_with_tax {MONEY},
        unit_price_without_tax {MONEY}, cgst_tax_rate {MONEY}, sgst_tax_rate {MONEY},
        igst_tax_rate {MONEY}, cgst_tax_amount {MONEY}, sgst_tax_amount {MONEY},
        igst_tax_amount {MONEY}, is_dc int, quantity {MONEY},
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "sale_orders": f"""id long, sale_order_date timestamp_ntz, net_total {MONEY},
        sales_channel string, state string, is_shipment int, contactable_type string,
        contactable_id long, billing_address string, branch_id long,
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "sale_order_payment_terms": "sale_order_id long, payment_term string",
    "sale_order_payment_term_after_deliveries": "sale_order_id long, no_of_days int",
    "sale_order_payment_term_installments":
        f"id long, sale_order_id long, installment_date date, amount {MONEY}",
    "invoice_items": f"""id long, sale_order_item_id long, invoice_id long,
        shipment_item_id long, quantity {MONEY}, is_bill int, is_dc int,
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "shipment_items": "id long, shipment_id long",
    "invoices": f"""id long, prefix string, is_bill int, cr_dr_state string, state string,
        round_off {MONEY}, date timestamp_ntz, net_total {MONEY},
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "shipments": "id long, sale_order_id long, created_at timestamp_ntz, updated_at timestamp_ntz",
    "shipment_state_logs": """shipment_id long, state string,
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "ledger_transactions": """id long, ledgerable_type string, ledgerable_id long,
        state string, transaction_datetime timestamp_ntz,
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "credit_debit_mappings": f"""debit_id long, credit_id long, amount {MONEY},
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "payments": """id long, cr_dr_state string, mode string, transaction_date date,
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "sale_order_state_logs": """sale_order_id long, state string,
        created_at timestamp_ntz, updated_at timestamp_ntz""",
    "edition_product_types": "id long, edition_id long, ref_code string",
    "editions": "id long, title_id long, name string",
    "titles": "id long, name string, master_title_type_id long, master_title_sub_type_id long",
    "master_title_types": "id long, name string",
    "master_title_sub_types": "id long, name string",
    "standard_meta_data": "id long, abbr string",
    "notebook_title_details": "id long",
    "customized_books": "id long, name string, standard_meta_data_id long",
    "branches": "id long, name string, sales_group_id long",
    "sales_groups": "id long, name string, rsm long",
    "employees": "id long, contact_id long",
    "contact_individual_details":
        "contact_id long, salutation string, first_name string, last_name string",
    "customers": "id long, billing_name string, role_id long",
    "c_roles": "id long, name string",
}

# The wide table's columns, in table order.
WIDE_SCHEMA = f"""
    sale_order_item_id long, itemParentable_type string, itemParentable_id long,
    saleable_type string, saleable_id long, sale_order_item_discount_percentage {MONEY},
    sale_order_item_mrp {MONEY}, unit_price_with_tax {MONEY}, unit_price_without_tax {MONEY},
    cgst_tax_rate {MONEY}, sgst_tax_rate {MONEY}, igst_tax_rate {MONEY},
    cgst_tax_amount {MONEY}, sgst_tax_amount {MONEY}, igst_tax_amount {MONEY}, is_dc int,
    is_customized int, sale_order_id long, sale_order_date timestamp_ntz,
    sale_order_net_total {MONEY}, sales_channel string, order_state string,
    title_name string, edition_name string, ref_code string, master_title_type string,
    master_title_sub_type string, meta_data string, invoice_item_id long,
    quantity {MONEY}, ii_quantity {MONEY}, final_ii_quantity decimal(38,2),
    is_both_invoiced int, is_partially_invoiced int, non_invoiced_quantity decimal(38,2),
    invoice_item_is_bill int, invoice_item_is_dc int, is_invoiced int, invoice_id long,
    invoice_prefix string, invoice_is_bill int, invoice_cr_dr_state string,
    invoice_state string, invoice_round_off {MONEY}, invoice_date timestamp_ntz,
    invoice_total_with_tax {MONEY}, payment_score double,
    total_unit_price_without_tax decimal(38,4), advance_amount decimal(38,2),
    cash_amount decimal(38,2), cheque_amount decimal(38,2), online_amount decimal(38,2),
    contactable_type string, sales_group_id long, sales_group_name string, rsm string,
    contactable_id long, customer_name string, customer_category string, branch_id long,
    branch_name string, address_city string, address_pincode string, address_state string,
    packed_2_delivered_tat_day int, create_2_processing_tat_day int,
    processing_2_complete_tat_day int, fetch_date timestamp_ntz
"""



def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def wide_schema() -> T.StructType:
    return struct(WIDE_SCHEMA)


def wide_columns() -> list[str]:
    return wide_schema().names


def _converted(name: str, have: T.DataType, want: T.DataType) -> str:
    timestamps = (T.TimestampType, T.TimestampNTZType)
    if have == want or (isinstance(have, timestamps) and isinstance(want, timestamps)):
        return f"`{name}`"
    kind = want.simpleString()
    if isinstance(have, (T.FloatType, T.DoubleType)):
        return f"cast(nullif(`{name}`, double('NaN')) as {kind}) as `{name}`"
    # Unreadable text becomes NULL instead of failing the job.
    cast = "try_cast" if isinstance(have, T.StringType) else "cast"
    return f"{cast}(`{name}` as {kind}) as `{name}`"


def conform(df: DataFrame, ddl: str, name: str = "table") -> DataFrame:
    """Select the columns of `ddl` in order, with their types; NaN becomes NULL.

    Zoned and zoneless timestamps are both kept as they are, so that filters on them
    still reach the scan.
    """
    have = {f.name: f.dataType for f in df.schema}
    want = struct(ddl)
    missing = [f.name for f in want if f.name not in have]
    if missing:
        raise ValueError(f"{name} lacks columns {missing}")
    return df.selectExpr(*[_converted(f.name, have[f.name], f.dataType) for f in want])
