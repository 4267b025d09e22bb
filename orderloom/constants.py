"""Names, states and dates the source database uses."""

from __future__ import annotations

from datetime import datetime

# Order states that reach the wide table.
ORDER_STATES = ["PARTIAL_COMPLETED", "COMPLETED", "FORCED_COMPLETED", "CANCELLED"]
# Order states that count as finished for turnaround times.
FINISHED_STATES = ["COMPLETED", "FORCED_COMPLETED"]
CANCELLED = "CANCELLED"

# States in the order log.
LOG_CREATED = "CREATED"
LOG_PROCESSING = ["SEND_FOR_DIGITAL", "PROCESSED"]
LOG_COMPLETED = "COMPLETED"

# States in the shipment log.
PACKED = "PACKED"
DELIVERED = "DELIVERED"

# Payments and ledger.
SETTLED_STATES = ["SETTLED", "PARTIAL_SETTLED"]
LEDGER_ACTIVE = "ACTIVE"
CASH, CHEQUE, ONLINE = "CASH", "CHEQUE", "ONLINE"

# Last parts of the class paths in *_type columns.
EDITION_PRODUCT = "EditionProductType"
CUSTOMIZED_BOOK = "CustomizedBook"
STANDARD_META_DATA = "StandardMetaData"
NOTEBOOK_TITLE_DETAIL = "NotebookTitleDetail"
INVOICE = "Invoice"
PAYMENT = "Payment"
CUSTOMER = "Customer"

# Other literals.
ON_DELIVERY_PATTERN = "%_ON_DELIVERY"
NOTEBOOK_LABEL = "Notebook"
CC_PREFIX = "CC"
TAT_CUTOFF = datetime(2022, 10, 1)

# Score of a cancelled order, score before deductions, deduction per day late.
CANCELLED_SCORE = -100.0
FULL_SCORE = 100.0
LATE_FACTOR = 0.5
