"""panelrep: scenario-panel indicator reporting on Spark.

Turns long-format scenario result tables (scenario, region, sector, year,
value) into one harmonised 8-column reporting table through many-to-many
bridges, strict sums, densification, ratios, base-year indices and baseline
comparisons -- all as lazy DataFrame plans.
"""

from .config import ReportConfig, TEMPLATE_COLUMNS  # noqa: F401
from .session import get_session  # noqa: F401
