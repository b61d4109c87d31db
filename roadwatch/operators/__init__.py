from roadwatch.operators.enrich import (
    last_write_per_row_key, limits_as_of, listed_cars_only, maybe_listed, newest_tracks, overspeed_passages, track_rows, tracks, with_limits,
)
from roadwatch.operators.matching import interval_join, pair_actions, pair_actions_replay, replay_fold
from roadwatch.operators.patterns import clone_plate_cars, clone_plates, dangerous_driving
from roadwatch.operators.windows import (
    area_distinct, area_distinct_approx, area_distinct_running, area_distinct_sliding, avg_speed, count_batches,
    distinct_from_panes, distinct_panes, duration_ms, top_n_monitors, with_event_time,
)
