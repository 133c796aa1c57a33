"""Query catalog: importing this package registers every query."""

from quarry.plans import q_bayes, q_eval, q_models, q_prep, q_relational, q_search, q_series, q_steps, q_text  # noqa: F401
from quarry.plans.catalog import ORACLE, QUERIES  # noqa: F401
