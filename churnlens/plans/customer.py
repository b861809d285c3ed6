"""R4/R5 the customer feature query (training and production forms).

Plan shape (one lazy plan, Catalyst/AQE pick the strategies)::

    contracts --F1--> J1 (items pre-aggregated per contract) --A2..A5 by customer--+
                                                                                    +--J8 left--> F9/A13 --> F7 --> T1
    tasks --F5,F2--> category flags (F3) --> history (only rows without end) ------+
          --> user group --> A7..A12 by customer

J2 (customers x tasks) is folded into J8: features are per customer and the
customer table has one row per customer, so aggregating all tasks first and
letting the LEFT JOIN from customers drop unknown customers gives the same rows,
reads the customer CTE once, and joins two one-row-per-customer tables
(no task fan-out, no skew in the join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators import contracts, features, tasks
from churnlens.rules import Rules
from churnlens.sources.roles import Roles


def customer_features(
    roles: Roles,
    rules: Rules,
    active_only: bool = False,
    customer_id: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """The base feature query: 29 columns, one row per customer with positive
    average task duration, ordered by that average (T1).

    ``active_only`` gives the production form (``churn = 0``, R5): only the
    tasks of active customers are enriched and aggregated.  ``customer_id`` is
    the single-customer parameter (S8), pushed to contracts and tasks.
    """
    customers = contracts.customer_base(roles, rules, customer_id)
    if active_only:
        customers = customers.where(F.col("churn") == 0)
    own = tasks.customer_tasks(roles, rules, customers=customers if active_only else None, customer_id=customer_id)
    feats = features.customer_task_features(own, rules)
    out = features.base_projection(features.join_customer_features(customers, feats), rules)
    out = features.having_positive_duration(out, active_only)
    if ordered:
        out = out.orderBy(F.col("media_dias_exec").asc(), F.col("cod_cliente").asc())
    return out


def customer_features_all(roles: Roles, rules: Rules) -> DataFrame:
    """F9 projection for every customer, before the final filter (customers
    without tasks show zeros)."""
    customers = contracts.customer_base(roles, rules)
    feats = features.customer_task_features(tasks.customer_tasks(roles, rules), rules)
    return features.base_projection(features.join_customer_features(customers, feats), rules)
