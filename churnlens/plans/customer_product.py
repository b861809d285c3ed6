"""R6/R7 the customer x product-group feature query.

Plan shape::

    contracts --F1,F2--> J9 (items pre-aggregated per contract, J10 inside)
              --> J11 (deduplicated) --> J12 --> A14 + F8 --> A16 by (customer, group) + F8
                                                                  |
    tasks --F2..F6, status J3--> A18 by (customer, product code) --J13 inner--> projection

J13 joins tasks on (customer, product code).  Every task attribute used by the
features comes from the task side, so tasks are aggregated per (customer,
product code) first and the aggregate is joined to the (customer, group) rows:
a task set that the SQL form would copy to several groups sharing a code is
aggregated once and its result copied instead.  Same rows, no fan-out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from churnlens.operators import contracts, features, tasks
from churnlens.rules import Rules
from churnlens.sources.roles import Roles


def customer_product_features(roles: Roles, rules: Rules, active_only: bool = False, customer_id: int | None = None) -> DataFrame:
    """The product-group query: one row per (customer, product group) with tasks.

    ``active_only`` gives the production form (R7): ``churn = 0`` in the
    group HAVING, plus the any-value ``dias_exec_tarefa`` column.  ``customer_id``
    is the single-customer parameter (S8), pushed to contracts and tasks.
    """
    groups = contracts.customer_products(roles, rules, active_only=active_only, customer_id=customer_id)
    feats = features.product_task_features(tasks.product_tasks(roles, rules, customer_id), rules, with_last_value=active_only)
    joined = groups.join(
        feats,
        (groups["cod_cliente"] == feats["cliente"]) & (groups["cod_gr_produto"] == feats["cod_ps"]),
        "inner",
    )
    return features.product_projection(joined, rules, with_last_value=active_only)
