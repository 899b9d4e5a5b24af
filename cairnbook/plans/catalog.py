"""All registered queries."""

from cairnbook.plans import events, files, records, reports, text  # noqa: F401
from cairnbook.plans.registry import ORACLES, QUERIES  # noqa: F401
