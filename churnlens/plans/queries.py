"""All registered queries: importing this module fills the registry."""

from churnlens.plans import catalog, catalog_analytics, catalog_models  # noqa: F401
from churnlens.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
