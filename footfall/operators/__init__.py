from footfall.operators.bursts import failure_bursts
from footfall.operators.capping import blacklist, click_cap, passed
from footfall.operators.late import split_late, with_watermark_before
from footfall.operators.matching import first_come_match, interval_join, reconcile
from footfall.operators.orders import order_status
from footfall.operators.sequence import match_sequence
from footfall.operators.streaks import anchored_alerts, chained_alerts, failure_streaks
from footfall.operators.topn import rank_within, top_n, top_n_sliding
from footfall.operators.uniques import (
    bitmap_rollup,
    bitmap_uniques,
    count_bitmaps,
    error_bound,
    exact_uniques,
    merge_bitmaps,
    sketch_rollup,
    sketch_uniques,
    sliding_sketches,
    sliding_uniques,
)
from footfall.operators.windows import (
    expand_runs,
    naive_sliding_counts,
    pane_counts,
    runs_of_panes,
    salted_tumbling_counts,
    sliding_count_runs,
    sliding_counts,
    summarize_runs,
    tumbling_counts,
)

__all__ = [name for name in dir() if not name.startswith("_")]
