r"""Expected results of the registered queries, as SQL for DuckDB.

The source tables are derived from the Parquet views just as `orderloom.sources.tpch` does.
On top of them each result is written the plain way: log rows joined in pairs, the ledger
joined once per measure, totals as windows over the joined rows, change tests over one outer
join. The engine computes them differently, so the comparison checks its rewrites.

Numbers are cast to DOUBLE or BIGINT and times to text, as the query side does.
"""

from __future__ import annotations

import re

SINCE = "1999-01-01 00:00:00"
CUTOFF = "1996-01-01 00:00:00"
FETCHED_AT = "2024-01-01 00:00:00"

TABLES = {
    "li": r"""
        SELECT (l_orderkey * 8 + l_linenumber) * 2097152
                   + round(l_extendedprice * 100)::BIGINT % 2097152 AS rid,
               l_orderkey AS okey, l_partkey AS part, l_suppkey AS supp, l_linenumber AS line,
               l_quantity::DECIMAL(18,2) AS quantity, l_extendedprice::DECIMAL(18,2) AS price,
               l_discount::DECIMAL(18,2) AS discount, l_tax::DECIMAL(18,2) AS tax,
               l_returnflag AS flag, l_linestatus AS status, l_shipdate AS shipped,
               l_shipdate + to_hours(l_linenumber) AS logged,
               l_orderkey * 10 + l_suppkey % 2 AS ikey,
               l_orderkey * 10 + l_linenumber % 2 AS skey
        FROM lineitem""",
    "sale_orders": r"""
        SELECT o_orderkey AS id, o_orderdate AS sale_order_date,
               o_totalprice::DECIMAL(18,2) AS net_total, o_orderpriority AS sales_channel,
               CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'PARTIAL_COMPLETED'
                    ELSE CASE o_orderkey % 4 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'FORCED_COMPLETED'
                              ELSE 'CREATED' END END AS state,
               o_orderkey % 2 AS is_shipment,
               CASE WHEN o_custkey % 11 = 0 THEN 'App\Models\Vendor'
                    ELSE 'App\Models\Customer' END AS contactable_type,
               o_custkey AS contactable_id, o_custkey % 25 AS branch_id,
               CASE WHEN o_orderkey % 6 <= 3 THEN 'City ' || (o_custkey % 100) END AS city,
               CASE WHEN o_orderkey % 6 <= 1 THEN '5' || lpad((o_custkey % 1000)::VARCHAR, 5, '0')
                    END AS pincode,
               CASE WHEN o_orderkey % 6 <= 2 THEN 'State ' || (o_custkey % 25) END AS region,
               o_orderkey % 6 = 4 AS unreadable,
               o_orderdate AS created_at, o_orderdate + to_days((o_orderkey % 90)::INT) AS updated_at
        FROM orders""",
    "sale_order_items": r"""
        SELECT rid AS id, okey AS sale_order_id,
               CASE part % 4 WHEN 0 THEN 'App\Models\StandardMetaData'
                    WHEN 1 THEN 'App\Models\NotebookTitleDetail'
                    WHEN 2 THEN 'App\Models\Other' END AS parent_type,
               part % 50 AS parent_id,
               CASE supp % 5 WHEN 0 THEN 'App\Models\CustomizedBook' WHEN 1 THEN 'App\Models\Service'
                    ELSE 'App\Models\EditionProductType' END AS saleable_type,
               part AS saleable_id, discount * 100 AS discount_percentage, price AS mrp,
               price AS unit_price_with_tax,
               (price * (1 - tax))::DECIMAL(18,2) AS unit_price_without_tax,
               tax * 50 AS half_rate, tax * 100 AS full_rate,
               price - (price * (1 - tax))::DECIMAL(18,2) AS tax_amount,
               part % 2 AS is_dc, quantity, shipped AS created_at,
               shipped + to_days(line) AS updated_at
        FROM li""",
    "payment_terms": r"""
        SELECT o_orderkey AS sale_order_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'CASH_ON_DELIVERY' WHEN 1 THEN 'AFTER_DELIVERY'
                    ELSE 'INSTALLMENT' END AS payment_term
        FROM orders WHERE o_orderkey % 10 <> 0
        UNION ALL
        SELECT o_orderkey, 'ADVANCE' FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 = 0""",
    "after_days": r"""
        SELECT o_orderkey AS sale_order_id, o_orderkey % 60 AS no_of_days
        FROM orders WHERE o_orderkey % 3 = 1""",
    "installments": r"""
        SELECT okey * 100 + line AS id, okey AS sale_order_id,
               max(shipped)::DATE AS installment_date, sum(price) AS amount
        FROM li WHERE okey % 3 = 2 AND line <= 3 GROUP BY okey, line""",
    "order_logs": r"""
        SELECT okey AS sale_order_id,
               CASE line WHEN 1 THEN 'CREATED' WHEN 2 THEN 'PROCESSED'
                    WHEN 3 THEN 'SEND_FOR_DIGITAL' WHEN 4 THEN 'COMPLETED' ELSE 'OTHER' END AS state,
               logged AS created_at, logged + to_days(1) AS updated_at
        FROM li""",
    "invoices": r"""
        SELECT ikey AS id, CASE WHEN okey % 3 = 0 THEN 'CC' ELSE 'IN' END AS prefix,
               okey % 2 AS is_bill, CASE WHEN okey % 4 = 0 THEN 'PENDING' ELSE 'SETTLED' END AS cr_dr_state,
               CASE WHEN okey % 5 = 0 THEN 'DRAFT' ELSE 'FINAL' END AS state, 0.25 AS round_off,
               max(shipped) AS date, sum(price) AS net_total, max(shipped) AS created_at,
               max(shipped) + to_days((okey % 30)::INT) AS updated_at
        FROM li WHERE status = 'F' GROUP BY ikey, okey""",
    "invoice_items": r"""
        SELECT rid AS id, rid AS sale_order_item_id, ikey AS invoice_id,
               CASE WHEN part % 4 <> 0 THEN rid END AS shipment_item_id,
               CASE WHEN part % 3 = 0 THEN floor(quantity / 2)::DECIMAL(18,2) ELSE quantity END AS quantity,
               okey % 2 AS is_bill, part % 2 AS is_dc, shipped AS created_at,
               shipped + to_days(3) AS updated_at
        FROM li WHERE status = 'F'
        UNION ALL
        SELECT -rid, rid, okey * 10 + (supp + 1) % 2, CASE WHEN part % 4 <> 0 THEN rid END, 1.00,
               okey % 2, part % 2, shipped, shipped + to_days(3)
        FROM li WHERE status = 'F' AND part % 5 = 0""",
    "shipment_items": "SELECT rid AS id, skey AS shipment_id FROM li",
    "shipments": r"""
        SELECT skey AS id, okey AS sale_order_id, min(shipped) AS created_at,
               max(shipped) AS updated_at
        FROM li GROUP BY skey, okey
        UNION ALL
        SELECT o_orderkey * 10 + 7, o_orderkey, o_orderdate, o_orderdate
        FROM orders WHERE o_orderkey % 50 = 0""",
    "shipment_logs": r"""
        SELECT skey AS shipment_id,
               CASE flag WHEN 'N' THEN 'PACKED' WHEN 'R' THEN 'DELIVERED' ELSE 'IN_TRANSIT' END AS state,
               logged AS created_at, logged + to_days(1) AS updated_at
        FROM li""",
    "payments": r"""
        SELECT rid AS id, CASE part % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'PARTIAL_SETTLED'
                               ELSE 'SETTLED' END AS cr_dr_state,
               CASE supp % 3 WHEN 0 THEN 'CASH' WHEN 1 THEN 'CHEQUE' ELSE 'ONLINE' END AS mode,
               CASE WHEN part % 97 <> 0 THEN shipped::DATE END AS paid_on,
               shipped AS created_at, shipped + to_days(1) AS updated_at
        FROM li WHERE line >= 5""",
    "ledger": r"""
        SELECT id, 'App\Models\Invoice' AS kind, id AS of_id,
               CASE WHEN id % 13 = 0 THEN 'VOID' ELSE 'ACTIVE' END AS state, date AS at,
               created_at, updated_at
        FROM invoices
        UNION ALL
        SELECT -rid, 'App\Models\Payment', rid, CASE WHEN rid % 17 = 0 THEN 'VOID' ELSE 'ACTIVE' END,
               shipped, shipped, shipped + to_days(2)
        FROM li WHERE line >= 5""",
    "mappings": r"""
        SELECT ikey AS debit_id, -rid AS credit_id, price AS amount, shipped AS created_at,
               shipped AS updated_at
        FROM li WHERE line >= 5""",
    "products": r"""
        SELECT p_partkey AS id, 'REF-' || p_partkey AS ref_code, p_brand AS edition_name,
               p_name AS title, 'TYPE ' || (p_size % 5) AS type_name, 'SUB ' || (p_size % 7) AS sub_name
        FROM part WHERE p_partkey % 9 <> 0""",
    "meta": "SELECT DISTINCT p_partkey % 50 AS id, 'SMD' || (p_partkey % 50) AS abbr FROM part",
    "books": r"""
        SELECT p_partkey AS id, 'Custom ' || p_name AS name, p_partkey % 60 AS meta_id
        FROM part WHERE p_partkey % 2 = 0""",
    "contacts": r"""
        SELECT s_suppkey + 1000 AS contact_id,
               CASE WHEN s_suppkey % 20 <> 10 THEN 'Mx ' END || s_name || ' of ' || s_nationkey AS name
        FROM supplier
        UNION ALL
        SELECT s_suppkey + 1000, 'Mx ' || s_name || ' the Second' FROM supplier
        WHERE s_suppkey % 20 = 0""",
    "branches": r"""
        SELECT n_nationkey AS branch_id, n_name AS branch_name, r_regionkey AS sales_group_id,
               r_name AS sales_group_name, c.name AS rsm
        FROM nation
        LEFT JOIN region ON r_regionkey = n_regionkey
        LEFT JOIN supplier ON s_suppkey = r_regionkey * 10
        LEFT JOIN contacts c ON c.contact_id = s_suppkey + 1000""",
    # Building blocks of the results.
    "lines": r"""
        SELECT inv.id AS invoice_id, m.amount, p.mode, p.paid_on, deb.at > cre.at AS is_advance,
               deb.created_at AS deb_c, deb.updated_at AS deb_u, cre.created_at AS cre_c,
               cre.updated_at AS cre_u, m.created_at AS map_c, m.updated_at AS map_u,
               p.created_at AS pay_c, p.updated_at AS pay_u
        FROM mappings m
        JOIN ledger deb ON deb.id = m.debit_id AND deb.kind LIKE '%Invoice' AND deb.state = 'ACTIVE'
        JOIN invoices inv ON inv.id = deb.of_id
        JOIN ledger cre ON cre.id = m.credit_id AND cre.kind LIKE '%Payment' AND cre.state = 'ACTIVE'
        JOIN payments p ON p.id = cre.of_id AND p.cr_dr_state IN ('SETTLED', 'PARTIAL_SETTLED')""",
    "advances": r"""
        SELECT invoice_id, sum(amount) AS advance_amount FROM lines WHERE is_advance
        GROUP BY invoice_id""",
    "modes": r"""
        SELECT invoice_id, coalesce(sum(amount) FILTER (mode = 'CASH'), 0) AS cash_amount,
               coalesce(sum(amount) FILTER (mode = 'CHEQUE'), 0) AS cheque_amount,
               coalesce(sum(amount) FILTER (mode = 'ONLINE'), 0) AS online_amount
        FROM lines GROUP BY invoice_id""",
    "deliveries": r"""
        SELECT s.id AS shipment_id, min(l.created_at) AS delivered_at
        FROM shipments s LEFT JOIN shipment_logs l ON l.shipment_id = s.id AND l.state = 'DELIVERED'
        GROUP BY s.id""",
    "ship_tat": rf"""
        SELECT s.sale_order_id, min(d.created_at::DATE - k.created_at::DATE) AS days,
               min(epoch(d.created_at) - epoch(k.created_at)) AS seconds,
               count(*) FILTER (s.created_at > '{SINCE}' OR k.created_at > '{SINCE}'
                                OR d.created_at > '{SINCE}') AS fresh
        FROM shipments s
        LEFT JOIN shipment_logs k ON k.shipment_id = s.id AND k.state = 'PACKED'
        LEFT JOIN shipment_logs d ON d.shipment_id = s.id AND d.state = 'DELIVERED'
        WHERE s.created_at > '{CUTOFF}'
        GROUP BY s.sale_order_id HAVING days IS NOT NULL""",
    "ord_tat": rf"""
        SELECT o.id AS sale_order_id, min(b.created_at::DATE - a.created_at::DATE) AS days,
               min(epoch(b.created_at) - epoch(a.created_at)) AS seconds,
               min(d.created_at::DATE - c.created_at::DATE) AS done_days,
               min(epoch(d.created_at) - epoch(c.created_at)) AS done_seconds,
               count(*) FILTER (a.created_at > '{SINCE}' OR b.created_at > '{SINCE}'
                                OR c.created_at > '{SINCE}' OR d.created_at > '{SINCE}') AS fresh
        FROM sale_orders o
        LEFT JOIN order_logs a ON a.sale_order_id = o.id AND a.state = 'CREATED'
        LEFT JOIN order_logs b ON b.sale_order_id = o.id AND b.state IN ('PROCESSED', 'SEND_FOR_DIGITAL')
        LEFT JOIN order_logs c ON c.sale_order_id = o.id AND c.state IN ('PROCESSED', 'SEND_FOR_DIGITAL')
        LEFT JOIN order_logs d ON d.sale_order_id = o.id AND d.state = 'COMPLETED'
        WHERE o.state IN ('COMPLETED', 'FORCED_COMPLETED') AND o.created_at > '{CUTOFF}'
        GROUP BY o.id HAVING days IS NOT NULL""",
    "plans": r"""
        SELECT p.sale_order_id, max(p.installment_date) AS last_date,
               string_agg(p.installment_date::VARCHAR, ',' ORDER BY p.installment_date, p.amount) AS dates,
               string_agg(p.amount::DECIMAL(18,2)::VARCHAR, ',' ORDER BY p.installment_date, p.amount) AS amounts
        FROM installments p
        JOIN sale_orders o ON o.id = p.sale_order_id AND o.state <> 'CANCELLED'
        GROUP BY p.sale_order_id""",
    "pay_days": r"""
        SELECT invoice_id,
               CASE WHEN count(paid_on) > 0 THEN
                   string_agg(coalesce(paid_on::VARCHAR, ''), ',' ORDER BY paid_on NULLS FIRST, amount)
               END AS payment_dates,
               string_agg(amount::VARCHAR, ',' ORDER BY paid_on NULLS FIRST, amount) AS all_payments
        FROM lines GROUP BY invoice_id""",
    "flat": r"""
        SELECT it.id AS item_id, it.*, o.id AS order_id, o.sale_order_date, o.net_total AS order_total,
               o.sales_channel, o.state AS order_state, o.is_shipment, o.contactable_type,
               o.contactable_id, o.branch_id, o.city, o.pincode, o.region, o.unreadable,
               pt.payment_term, ad.no_of_days, plans.last_date, plans.dates AS plan_dates,
               plans.amounts AS plan_amounts,
               plans.sale_order_id IS NOT NULL AS has_plan,
               x.id AS x_id, coalesce(x.quantity, 0) AS x_quantity, x.is_bill AS x_is_bill,
               x.is_dc AS x_is_dc, inv.id AS invoice_id, inv.prefix, inv.is_bill AS invoice_is_bill,
               inv.cr_dr_state, inv.state AS invoice_state, inv.round_off, inv.date AS invoice_date,
               coalesce(inv.net_total, 0) AS invoice_total, dl.delivered_at,
               CASE WHEN pt.payment_term LIKE '%_ON_DELIVERY' THEN dl.delivered_at
                    WHEN dl.delivered_at IS NOT NULL THEN dl.delivered_at + to_days(ad.no_of_days::INT)
                    ELSE inv.date + to_days(ad.no_of_days::INT) END AS committed,
               adv.advance_amount, modes.cash_amount, modes.cheque_amount, modes.online_amount,
               pd.payment_dates, pd.all_payments, st.days AS ship_days, st.seconds AS ship_seconds, ot.days AS ord_days,
               ot.seconds AS ord_seconds, ot.done_days, ot.done_seconds,
               pr.ref_code, pr.edition_name, pr.type_name, pr.sub_name,
               CASE WHEN bk.id IS NULL THEN pr.title ELSE bk.name END AS title_name,
               CASE WHEN it.parent_type LIKE '%StandardMetaData' THEN mt.abbr
                    WHEN it.parent_type LIKE '%NotebookTitleDetail' THEN 'Notebook'
                    WHEN bk.id IS NOT NULL THEN bm.abbr END AS meta_data,
               br.branch_name, br.sales_group_id, br.sales_group_name, br.rsm,
               cu.c_name AS customer_name, cu.c_mktsegment AS customer_category
        FROM sale_order_items it
        JOIN sale_orders o ON o.id = it.sale_order_id
        LEFT JOIN payment_terms pt ON pt.sale_order_id = o.id
        LEFT JOIN after_days ad ON ad.sale_order_id = o.id
        LEFT JOIN plans ON plans.sale_order_id = o.id
        LEFT JOIN invoice_items x ON x.sale_order_item_id = it.id
        LEFT JOIN shipment_items si ON si.id = x.shipment_item_id
        LEFT JOIN deliveries dl ON dl.shipment_id = si.shipment_id
        LEFT JOIN invoices inv ON inv.id = x.invoice_id
        LEFT JOIN advances adv ON adv.invoice_id = inv.id
        LEFT JOIN modes ON modes.invoice_id = inv.id
        LEFT JOIN pay_days pd ON pd.invoice_id = inv.id
        LEFT JOIN ship_tat st ON st.sale_order_id = o.id
        LEFT JOIN ord_tat ot ON ot.sale_order_id = o.id
        LEFT JOIN products pr ON pr.id = it.saleable_id
        LEFT JOIN meta mt ON mt.id = it.parent_id AND it.parent_type LIKE '%StandardMetaData'
             AND it.saleable_type LIKE '%EditionProductType'
        LEFT JOIN books bk ON bk.id = it.saleable_id AND it.saleable_type LIKE '%CustomizedBook'
        LEFT JOIN meta bm ON bm.id = bk.meta_id
        LEFT JOIN branches br ON br.branch_id = o.branch_id
        LEFT JOIN customer cu ON cu.c_custkey = o.contactable_id AND o.contactable_type LIKE '%Customer'
        WHERE (it.saleable_type LIKE '%EditionProductType' OR it.saleable_type LIKE '%CustomizedBook')
          AND o.state IN ('PARTIAL_COMPLETED', 'COMPLETED', 'FORCED_COMPLETED', 'CANCELLED')""",
    "due": r"""
        SELECT *, CASE WHEN has_plan THEN last_date ELSE committed::DATE END AS due_on,
               sum(x_quantity) OVER (PARTITION BY item_id) AS item_quantity
        FROM flat""",
    "scores": r"""
        SELECT k.invoice_id, k.due_on, count(amount) AS payments, bool_or(paid_on IS NULL) AS undated,
               100 - sum(0.5 * amount::DOUBLE / k.invoice_total::DOUBLE
                         * CASE WHEN paid_on > k.due_on THEN paid_on - k.due_on ELSE 0 END) AS score
        FROM (SELECT DISTINCT invoice_id, due_on, invoice_total FROM due
              WHERE invoice_id IS NOT NULL AND due_on IS NOT NULL AND invoice_total <> 0) k
        JOIN lines USING (invoice_id) GROUP BY k.invoice_id, k.due_on""",
    "scored": r"""
        SELECT due.*, CASE WHEN order_state = 'CANCELLED' THEN -100.0
                           WHEN NOT undated THEN scores.score END AS payment_score
        FROM due LEFT JOIN scores USING (invoice_id, due_on)""",
}

_WIDE = rf"""
    item_id AS sale_order_item_id, split_part(parent_type, '\', -1) AS itemParentable_type,
    parent_id::BIGINT AS itemParentable_id, split_part(saleable_type, '\', -1) AS saleable_type,
    saleable_id::BIGINT AS saleable_id,
    discount_percentage::DOUBLE AS sale_order_item_discount_percentage,
    mrp::DOUBLE AS sale_order_item_mrp, unit_price_with_tax::DOUBLE AS unit_price_with_tax,
    unit_price_without_tax::DOUBLE AS unit_price_without_tax, half_rate::DOUBLE AS cgst_tax_rate,
    half_rate::DOUBLE AS sgst_tax_rate, full_rate::DOUBLE AS igst_tax_rate,
    tax_amount::DOUBLE AS cgst_tax_amount, tax_amount::DOUBLE AS sgst_tax_amount,
    0::DOUBLE AS igst_tax_amount, is_dc::BIGINT AS is_dc,
    (saleable_type LIKE '%CustomizedBook')::BIGINT AS is_customized,
    order_id::BIGINT AS sale_order_id,
    strftime(sale_order_date, '%Y-%m-%d %H:%M:%S') AS sale_order_date,
    order_total::DOUBLE AS sale_order_net_total, sales_channel, order_state, title_name,
    edition_name, ref_code, type_name AS master_title_type, sub_name AS master_title_sub_type,
    meta_data, x_id::BIGINT AS invoice_item_id, quantity::DOUBLE AS quantity,
    x_quantity::DOUBLE AS ii_quantity, item_quantity::DOUBLE AS final_ii_quantity,
    0::BIGINT AS is_both_invoiced,
    (item_quantity > 0 AND quantity > item_quantity)::BIGINT AS is_partially_invoiced,
    (quantity - item_quantity)::DOUBLE AS non_invoiced_quantity,
    x_is_bill::BIGINT AS invoice_item_is_bill, x_is_dc::BIGINT AS invoice_item_is_dc,
    (item_quantity > 0)::BIGINT AS is_invoiced, invoice_id::BIGINT AS invoice_id,
    prefix AS invoice_prefix, invoice_is_bill::BIGINT AS invoice_is_bill,
    cr_dr_state AS invoice_cr_dr_state, invoice_state, round_off::DOUBLE AS invoice_round_off,
    strftime(invoice_date, '%Y-%m-%d %H:%M:%S') AS invoice_date,
    invoice_total::DOUBLE AS invoice_total_with_tax,
    round(payment_score::DOUBLE, 4) AS payment_score,
    (x_quantity * unit_price_without_tax)::DOUBLE AS total_unit_price_without_tax,
    advance_amount::DOUBLE AS advance_amount, cash_amount::DOUBLE AS cash_amount,
    cheque_amount::DOUBLE AS cheque_amount, online_amount::DOUBLE AS online_amount,
    contactable_type, sales_group_id::BIGINT AS sales_group_id, sales_group_name, rsm,
    contactable_id::BIGINT AS contactable_id, customer_name, customer_category,
    branch_id::BIGINT AS branch_id, branch_name, city AS address_city, pincode AS address_pincode,
    region AS address_state, ship_days::BIGINT AS packed_2_delivered_tat_day,
    ord_days::BIGINT AS create_2_processing_tat_day,
    done_days::BIGINT AS processing_2_complete_tat_day, '{FETCHED_AT}' AS fetch_date
"""

_DETAIL = r"""
    item_id AS sale_order_item_id, x_id::BIGINT AS invoice_item_id, rsm, payment_term,
    is_shipment::BIGINT AS is_shipment, no_of_days::BIGINT AS payment_after_no_of_days,
    strftime(coalesce(delivered_at, invoice_date), '%Y-%m-%d %H:%M:%S') AS delivery_date,
    strftime(committed, '%Y-%m-%d %H:%M:%S') AS payment_commitment_date,
    has_plan::BIGINT AS is_installment, plan_dates AS installment_dates,
    plan_amounts AS installment_amounts, payment_dates, all_payments,
    unreadable::BIGINT AS address_rejected,
    ship_seconds::BIGINT AS packed_2_delivered_tat_seconds,
    ord_seconds::BIGINT AS create_2_processing_tat_seconds,
    done_seconds::BIGINT AS processing_2_complete_tat_seconds
"""


def _changed(stamp: str, logs: bool, recent: bool, eligible: bool, least: int) -> str:
    """Ids changed by one time stamp, over one outer join of everything that is tested."""
    s = stamp[0]
    log_test = f"OR st.fresh > {least} OR ot.fresh > {least}" if logs else ""
    recent_test = f"AND o.created_at >= '{SINCE}'" if recent else ""
    states = "('PARTIAL_COMPLETED', 'COMPLETED', 'FORCED_COMPLETED', 'CANCELLED')"
    state_test = f"AND o.state IN {states}" if eligible else ""
    return rf"""
        SELECT DISTINCT o.id AS sale_order_id
        FROM sale_orders o
        JOIN sale_order_items it ON it.sale_order_id = o.id
        LEFT JOIN invoice_items x ON x.sale_order_item_id = it.id
        LEFT JOIN invoices inv ON inv.id = x.invoice_id
        LEFT JOIN (SELECT invoice_id, count(*) FILTER (deb_{s} > '{SINCE}' OR cre_{s} > '{SINCE}'
                          OR map_{s} > '{SINCE}' OR pay_{s} > '{SINCE}') AS fresh
                   FROM lines GROUP BY invoice_id) pay ON pay.invoice_id = inv.id
        LEFT JOIN (SELECT invoice_id, count(*) FILTER (deb_{s} > '{SINCE}' OR cre_{s} > '{SINCE}'
                          OR map_{s} > '{SINCE}' OR pay_{s} > '{SINCE}') AS fresh
                   FROM lines WHERE is_advance GROUP BY invoice_id) adv ON adv.invoice_id = inv.id
        LEFT JOIN ship_tat st ON st.sale_order_id = o.id
        LEFT JOIN ord_tat ot ON ot.sale_order_id = o.id
        WHERE (it.saleable_type LIKE '%EditionProductType' OR it.saleable_type LIKE '%CustomizedBook')
          {state_test} {recent_test}
          AND (o.{stamp} > '{SINCE}' OR it.{stamp} > '{SINCE}' OR x.{stamp} > '{SINCE}'
               OR inv.{stamp} > '{SINCE}' OR pay.fresh > 0 OR adv.fresh > 0 {log_test})"""


CREATED_IDS = _changed("created_at", True, True, True, 1)
UPDATED_IDS = _changed("updated_at", False, True, True, 1)
CHANGED_IDS = f"{CREATED_IDS} UNION {UPDATED_IDS}"
INTENDED_IDS = (
    _changed("created_at", True, False, False, 0) + " UNION "
    + _changed("updated_at", False, False, False, 0)
)


def _branch(name: str, stamp: str) -> str:
    """Ids changed for one reason alone, over the tables it needs."""
    s = stamp[0]
    lines = f"""JOIN invoice_items x ON x.sale_order_item_id = it.id
         JOIN invoices inv ON inv.id = x.invoice_id JOIN lines ON lines.invoice_id = inv.id"""
    joins, test = {
        "order": ("", f"o.{stamp} > '{SINCE}'"),
        "item": ("", f"it.{stamp} > '{SINCE}'"),
        "invoice_item": (
            "JOIN invoice_items x ON x.sale_order_item_id = it.id", f"x.{stamp} > '{SINCE}'"
        ),
        "invoice": (
            """JOIN invoice_items x ON x.sale_order_item_id = it.id
               JOIN invoices inv ON inv.id = x.invoice_id""",
            f"inv.{stamp} > '{SINCE}'",
        ),
        "invoice_entry": (lines, f"deb_{s} > '{SINCE}'"),
        "mapping": (lines, f"map_{s} > '{SINCE}'"),
        "payment_entry": (lines, f"cre_{s} > '{SINCE}'"),
        "payment": (lines, f"pay_{s} > '{SINCE}'"),
        "order_log": ("JOIN ord_tat ot ON ot.sale_order_id = o.id", "ot.fresh > 1"),
        "shipment_log": ("JOIN ship_tat st ON st.sale_order_id = o.id", "st.fresh > 1"),
    }[name]
    return rf"""
        SELECT DISTINCT o.id AS sale_order_id, '{name}' AS branch, '{stamp}' AS stamp
        FROM sale_orders o JOIN sale_order_items it ON it.sale_order_id = o.id {joins}
        WHERE (it.saleable_type LIKE '%EditionProductType' OR it.saleable_type LIKE '%CustomizedBook')
          AND {test}"""


_BRANCHES = ["order", "item", "invoice_item", "invoice", "invoice_entry", "mapping", "payment_entry", "payment"]
BRANCH_IDS = " UNION ALL ".join(
    [_branch(b, s) for b in _BRANCHES for s in ("created_at", "updated_at")]
    + [_branch(b, "created_at") for b in ("order_log", "shipment_log")]
)

# The same tables with one item, invoice and order that hold a large part of the rows, and
# many lines without a shipment.
TABLES |= {
    "hot": r"""
        SELECT min(it.id) AS item, min(o.id) AS order_id, min(inv.id) AS invoice
        FROM sale_order_items it JOIN sale_orders o ON o.id = it.sale_order_id
        JOIN invoice_items x ON x.sale_order_item_id = it.id JOIN invoices inv ON inv.id = x.invoice_id
        WHERE it.saleable_type LIKE '%EditionProductType' AND o.state = 'COMPLETED'""",
    "skewed_items": r"""
        SELECT it.* REPLACE (CASE WHEN it.id % 4 = 1 THEN hot.order_id ELSE it.sale_order_id END AS sale_order_id)
        FROM sale_order_items it CROSS JOIN hot""",
    "skewed_lines": r"""
        SELECT x.* REPLACE (
            CASE WHEN x.id % 3 = 0 THEN hot.item ELSE x.sale_order_item_id END AS sale_order_item_id,
            CASE WHEN x.id % 2 = 0 THEN hot.invoice ELSE x.invoice_id END AS invoice_id,
            CASE WHEN x.id % 5 > 1 THEN x.shipment_item_id END AS shipment_item_id)
        FROM invoice_items x CROSS JOIN hot""",
}
for _name in ("flat", "due", "scores", "scored"):
    _sql = TABLES[_name].replace("FROM sale_order_items it", "FROM skewed_items it")
    _sql = _sql.replace("JOIN invoice_items x", "JOIN skewed_lines x")
    for _other in ("flat", "due", "scores"):
        _sql = re.sub(rf"\b(FROM|JOIN) {_other}\b", rf"\1 skewed_{_other}", _sql)
    TABLES[f"skewed_{_name}"] = _sql.replace("due.*", "skewed_due.*").replace("scores.score", "skewed_scores.score")

_ITEM_TOTALS = """
        SELECT item_id AS sale_order_item_id, max(item_quantity)::DOUBLE AS final_ii_quantity,
               max((item_quantity > 0)::BIGINT) AS is_invoiced,
               max((item_quantity > 0 AND quantity > item_quantity)::BIGINT) AS is_partially_invoiced,
               max(quantity - item_quantity)::DOUBLE AS non_invoiced_quantity, count(*)::BIGINT AS n
        FROM due GROUP BY item_id"""

RESULTS = {
    "wide_build": f"SELECT {_WIDE} FROM scored",
    "wide_detail": f"SELECT {_DETAIL} FROM flat",
    "wide_for_changed": f"SELECT {_WIDE} FROM scored WHERE order_id IN ({CHANGED_IDS})",
    "ledger_mode_pivot": """
        SELECT invoice_id, cash_amount::DOUBLE AS cash_amount,
               cheque_amount::DOUBLE AS cheque_amount, online_amount::DOUBLE AS online_amount
        FROM modes""",
    "ledger_advance": "SELECT invoice_id, advance_amount::DOUBLE AS advance_amount FROM advances",
    "payment_list": """
        SELECT invoice_id, strftime(paid_on, '%Y-%m-%d') AS paid_on, sum(amount)::DOUBLE AS amount,
               count(amount)::BIGINT AS payments
        FROM lines GROUP BY invoice_id, paid_on""",
    "first_delivery": """
        SELECT shipment_id, strftime(delivered_at, '%Y-%m-%d %H:%M:%S') AS delivered_at
        FROM deliveries WHERE delivered_at IS NOT NULL""",
    "shipment_tat": """
        SELECT sale_order_id, days::BIGINT AS packed_2_delivered_tat_day,
               seconds::BIGINT AS packed_2_delivered_tat_seconds FROM ship_tat""",
    "order_tat": """
        SELECT sale_order_id, days::BIGINT AS create_2_processing_tat_day,
               seconds::BIGINT AS create_2_processing_tat_seconds,
               done_days::BIGINT AS processing_2_complete_tat_day,
               done_seconds::BIGINT AS processing_2_complete_tat_seconds FROM ord_tat""",
    "shipment_changes": """
        SELECT sale_order_id, fresh::BIGINT AS changed_rows FROM ship_tat""",
    "order_changes": "SELECT sale_order_id, fresh::BIGINT AS changed_rows FROM ord_tat",
    "shipment_span": """
        SELECT *, rank() OVER (ORDER BY span_days NULLS FIRST) AS place
        FROM (SELECT s.id AS shipment_id,
                     (max(l.created_at)::DATE - min(l.created_at)::DATE)::BIGINT AS span_days
              FROM shipments s LEFT JOIN shipment_logs l ON l.shipment_id = s.id GROUP BY s.id)""",
    "payment_rows": """
        SELECT invoice_id, strftime(paid_on, '%Y-%m-%d') AS paid_on, amount::DOUBLE AS amount, mode,
               is_advance::BIGINT AS is_advance FROM lines""",
    "payment_lists": "SELECT invoice_id, payment_dates, all_payments FROM pay_days",
    "installment_lists": """
        SELECT sale_order_id, string_agg(installment_date::VARCHAR, ',' ORDER BY installment_date, amount)
                   AS installment_dates,
               string_agg(amount::DECIMAL(18,2)::VARCHAR, ',' ORDER BY installment_date, amount)
                   AS installment_amounts
        FROM installments GROUP BY sale_order_id""",
    "stored_figures": """
        SELECT round(t.high, 6) AS average_with_tax, round(t.value, 6) AS average_without_tax,
               round(d.discount, 6) AS average_discount, round(c.share, 6) AS cc_percentage
        FROM (SELECT avg(high::DOUBLE) AS high, avg(value::DOUBLE) AS value
              FROM (SELECT max(invoice_total) AS high, sum(x_quantity * unit_price_without_tax) AS value
                    FROM flat WHERE order_state <> 'CANCELLED' GROUP BY order_id)) t,
             (SELECT avg(discount_percentage::DOUBLE) AS discount FROM flat
              WHERE is_dc = 1 AND invoice_total > 0 AND order_state <> 'CANCELLED') d,
             (SELECT sum(x_quantity) FILTER (prefix = 'CC')::DOUBLE / sum(x_quantity)::DOUBLE * 100 AS share
              FROM flat WHERE order_state <> 'CANCELLED') c""",
    "installment_rows": """
        SELECT sale_order_id, strftime(installment_date, '%Y-%m-%d') AS installment_date,
               amount::DOUBLE AS amount FROM installments""",
    "mode_totals_any_case": """
        SELECT invoice_id, cash_amount::DOUBLE AS cash_amount,
               cheque_amount::DOUBLE AS cheque_amount, online_amount::DOUBLE AS online_amount
        FROM modes""",
    "conformed_values": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS read_id,
               CASE WHEN c_custkey % 5 <> 0 THEN c_custkey::DOUBLE / 4 END AS balance,
               CASE WHEN c_custkey % 3 <> 0 THEN '1999-05-0' || c_custkey % 3 END AS day
        FROM customer""",
    "wide_skewed": r"""
        SELECT item_id AS sale_order_item_id, x_id::BIGINT AS invoice_item_id, payment_term, rsm,
               order_id AS sale_order_id, invoice_id::BIGINT AS invoice_id,
               item_quantity::DOUBLE AS final_ii_quantity, (item_quantity > 0)::BIGINT AS is_invoiced,
               round(payment_score::DOUBLE, 4) AS payment_score,
               strftime(coalesce(delivered_at, invoice_date), '%Y-%m-%d %H:%M:%S') AS delivery_date,
               title_name, customer_name
        FROM skewed_scored""",
    "changed_orders_by_branch": BRANCH_IDS,
    "incremental_run": f"""
        SELECT item_id AS sale_order_item_id, x_id::BIGINT AS invoice_item_id, order_id AS sale_order_id,
               item_quantity::DOUBLE AS final_ii_quantity,
               CASE WHEN order_id IN ({CHANGED_IDS}) THEN '{FETCHED_AT}' ELSE '{SINCE}' END AS fetch_date,
               '{FETCHED_AT}' AS mark
        FROM due""",
    "streamed_run": f"""
        SELECT item_id AS sale_order_item_id, x_id::BIGINT AS invoice_item_id, order_id AS sale_order_id,
               item_quantity::DOUBLE AS final_ii_quantity,
               CASE WHEN order_id IN ({INTENDED_IDS}) THEN '{FETCHED_AT}' ELSE '{SINCE}' END AS fetch_date
        FROM due""",
    "installments_by_order": """
        SELECT sale_order_id, strftime(max(installment_date), '%Y-%m-%d') AS installment_due,
               count(*)::BIGINT AS installments FROM installments GROUP BY sale_order_id""",
    "commitment_date": """
        SELECT item_id AS sale_order_item_id, x_id::BIGINT AS invoice_item_id, payment_term,
               strftime(committed, '%Y-%m-%d %H:%M:%S') AS payment_commitment_date, rsm FROM flat""",
    "payment_score": """
        SELECT item_id AS sale_order_item_id, x_id::BIGINT AS invoice_item_id, payment_term, rsm,
               round(payment_score::DOUBLE, 4) AS payment_score FROM scored""",
    "item_invoiced_totals": _ITEM_TOTALS,
    "item_totals_bucketed": _ITEM_TOTALS,
    "order_invoice_counts": """
        SELECT order_id AS sale_order_id, (count(DISTINCT invoice_id) > 1)::BIGINT AS is_both_invoiced
        FROM flat GROUP BY order_id""",
    "type_shortening": r"""
        SELECT id AS sale_order_item_id, split_part(parent_type, '\', -1) AS itemParentable_type,
               split_part(saleable_type, '\', -1) AS saleable_type FROM sale_order_items""",
    "address_fields": """
        SELECT id AS sale_order_id, city AS address_city, pincode AS address_pincode,
               region AS address_state, unreadable::BIGINT AS rejected FROM sale_orders""",
    "product_titles": """
        SELECT id AS saleable_id, ref_code, edition_name, title AS catalog_title,
               type_name AS master_title_type, sub_name AS master_title_sub_type FROM products""",
    "rsm_names": """
        SELECT branch_id::BIGINT AS branch_id, branch_name, sales_group_id::BIGINT AS sales_group_id,
               sales_group_name, rsm FROM branches""",
    "customer_dim": """
        SELECT c_custkey AS contactable_id, c_name AS customer_name,
               c_mktsegment AS customer_category FROM customer""",
    "changed_orders_created": CREATED_IDS,
    "changed_orders_updated": UPDATED_IDS,
    "changed_orders": CHANGED_IDS,
    "changed_orders_intended": INTENDED_IDS,
    "changed_orders_clustered": INTENDED_IDS,
    "keyed_replace": f"""
        SELECT id AS sale_order_id, net_total::DOUBLE AS net_total,
               (id IN ({CHANGED_IDS}) AND state <> 'CANCELLED')::BIGINT AS is_new
        FROM sale_orders
        WHERE NOT (id IN ({CHANGED_IDS}) AND state = 'CANCELLED')""",
    "average_ticket_size": """
        SELECT round(avg(high::DOUBLE), 6) AS average_with_tax,
               round(avg(value::DOUBLE), 6) AS average_without_tax
        FROM (SELECT max(invoice_total) AS high, sum(x_quantity * unit_price_without_tax) AS value
              FROM flat WHERE order_state <> 'CANCELLED' GROUP BY order_id)""",
    "average_discount": """
        SELECT round(avg(discount_percentage::DOUBLE), 6) AS average_discount FROM flat
        WHERE is_dc = 1 AND invoice_total > 0 AND order_state <> 'CANCELLED'""",
    "cc_share": """
        SELECT round(a.cc::DOUBLE / b.everything::DOUBLE * 100, 6) AS cc_percentage
        FROM (SELECT sum(x_quantity) AS cc FROM flat
              WHERE prefix = 'CC' AND order_state <> 'CANCELLED') a,
             (SELECT sum(x_quantity) AS everything FROM flat WHERE order_state <> 'CANCELLED') b""",
}


def with_tables(query: str) -> str:
    """The query, preceded by those derived tables it uses, directly or not."""
    used: dict[str, str] = {}

    def visit(sql: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql):
            if name in TABLES and name not in used:
                visit(TABLES[name])
                used[name] = TABLES[name]

    visit(query)
    if not used:
        return query
    tables = ",\n".join(f"{name} AS ({sql})" for name, sql in used.items())
    return f"WITH {tables}\n{query}"
