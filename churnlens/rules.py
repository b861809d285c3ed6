"""Business rules of the feature queries, as parameters.

Every code list, text pattern and date of the feature queries lives here, so
the same builders run on the reference's production codes or on another
mapping (the driver's TPC-H-like tables, ``DRIVER_RULES``).

Set-membership rules are SQL boolean expressions over the role column names
(``grupo_trabalho``, ``categoria``, ``item``).  Spark evaluates them with
``F.expr`` inside whole-stage codegen, and the DuckDB oracle pastes the same
text, so a rule is written once.  A code list is simply ``"x IN (1, 2)"``; a
large code set can be a range or any other predicate instead of a huge list.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Rules:
    # reference date replacing CURDATE(); always explicit, never current_date
    as_of: str
    # contract status codes
    status_active: int
    status_cancelled: int
    # task status codes dropped before aggregating (cancelled, billing)
    excluded_task_status: tuple[str, ...]
    # lower-case word: tasks whose category or subcategory text contains it are dropped
    excluded_text: str
    # lower-case word marking "bug" tasks (category or subcategory text)
    bug_text: str
    # status description word: tasks waiting on the customer (product-group query)
    return_text: str
    # status values of a finished task (product-group query)
    finished_status: tuple[str, ...]
    # group and category sets (SQL predicates over role columns)
    sd_group: str
    hd_group: str
    complaint_category: str
    reduction_category: str
    unimportant_category: str
    user_licence_item: str
    # customers excluded from the product-group query (internal accounts)
    excluded_customers: tuple[int, ...]
    # product-group text that marks a product of interest (case-insensitive contains)
    product_flag_text: str
    # (case-insensitive text, product code), first match wins
    product_codes: tuple[tuple[str, int], ...]
    # label for items without a product group
    missing_group_label: str
    # main-task product codes kept by the product-group query
    main_product_codes: tuple[int, ...] = field(default=())


# ---------------------------------------------------------------------------
# Fixed values of the reference workload (its production code lists and
# texts).  They must stay as they are for results equal to the reference.
# ---------------------------------------------------------------------------
def reference_rules(as_of: str) -> Rules:
    """The workload's rules as of a day (``YYYY-MM-DD``), which the caller names."""
    return Rules(
        as_of=as_of,
        status_active=3,
        status_cancelled=4,
        excluded_task_status=("CAN", "PGE"),
        excluded_text="cancel",
        bug_text="bug",
        return_text="RETORNO",
        finished_status=("X", "V"),
        sd_group="grupo_trabalho IN (3, 29, 64)",
        hd_group="grupo_trabalho IN (5, 23, 63)",
        complaint_category="categoria IN (304)",
        reduction_category="categoria IN (18402, 18441, 18468)",
        unimportant_category=(
            "categoria IN (210, 224, 225, 352, 367, 16375, 15693, 17367, 17536, 18327, 21486)"
        ),
        user_licence_item="item IN (2, 20, 24, 109, 10022, 139, 50, 10023, 10012, 10095)",
        excluded_customers=(8433, 27710, 34000, 36363, 36511, 28306, 37187, 36603, 35653, 19620, 43194),
        product_flag_text="CPJ",
        product_codes=(("CPJ-3C", 67), ("CPJ-COB", 18)),
        missing_group_label="NÃO CONSTA",
        main_product_codes=(18, 67),
    )

# The same rules mapped onto the driver's generated tables (see FIXTURES.md).
DRIVER_RULES = Rules(
    as_of="2001-12-31",
    status_active=3,
    status_cancelled=4,
    excluded_task_status=("RF", "NF"),
    excluded_text="rod",
    bug_text="widget",
    return_text="RETORNO",
    finished_status=("X", "V"),
    sd_group="grupo_trabalho BETWEEN 0 AND 7",
    hd_group="grupo_trabalho BETWEEN 8 AND 15",
    complaint_category="categoria % 25 = 4",
    reduction_category="categoria % 25 IN (7, 8)",
    unimportant_category="categoria % 25 = 11",
    user_licence_item="item % 2 = 0",
    excluded_customers=(0, 7),
    product_flag_text="o",
    product_codes=(("PROMO", 67), ("ECONOMY", 18)),
    missing_group_label="NÃO CONSTA",
    main_product_codes=(18, 67),
)

# Priority buckets of the task features: (output suffix, SQL predicate).
# Fixed values of the reference workload.
PRIORITY_BUCKETS = (
    ("normal", "prioridade IN (0, 1)"),
    ("parcial", "prioridade = 2"),
    ("urgente", "prioridade = 3"),
    ("maxima", "prioridade = 4"),
    ("reforco", "prioridade = 9"),
)

# Risk segments of the scored report: labels in order, right-closed bin edges.
# Fixed values of the reference workload.
RISK_LABELS = ("Saudável", "Atenção", "Crítico")
RISK_EDGES = (0.0, 0.3, 0.7, 1.0)
