from clientlens.operators.groups import (  # noqa: F401
    above_avg_by_group, avg_by_group, avg_by_quarter, avg_median_by_group,
    band_stats, busiest, count_by, filtered_count_by_group, global_metrics,
    hit_rate, mean, month_quarter, month_status_crosstab, monthly_trend,
    pivot_counts, rate_by_group, top_k, topk_avg_with_rate, topk_band_avg,
    topk_rate,
)
from clientlens.operators.profile import (  # noqa: F401
    approx_fences, corr, describe_numeric, iqr_fences, null_counts, partition_keys, partition_rows, partition_stats, preview,
    spread_by_group, total_count, winsorize_iqr,
)
from clientlens.operators.quantiles import (  # noqa: F401,E402
    exact_quantiles, quantile_by_group_exact,
)
from clientlens.operators.sketches import (  # noqa: F401,E402
    merge_sketches, quantile_sketches, sketch_quantiles,
)
from clientlens.operators.shared import shared_scan  # noqa: F401,E402
