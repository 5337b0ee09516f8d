from .columns import (  # noqa: F401
    VALID_PLANS,
    age_group,
    avg_half_up,
    engagement_level,
    engagement_score,
    half_up,
    half_up_sql,
    is_completed,
    is_premium,
    share_pct,
    sum_scaled,
)
from .sql import register_sql_functions  # noqa: F401
