from roadwatch.streaming.bounded import end_input, run_to_end, with_end
from roadwatch.streaming.jobs import (
    passage_stream, processing_timed, start, stream_area_distinct, stream_area_distinct_approx, stream_area_distinct_clock,
    stream_area_distinct_bloom, stream_area_distinct_running, stream_avg_speed, stream_clone_plates,
    stream_dangerous_driving, stream_distinct_panes, stream_interval_join, stream_limits_as_of, stream_overspeed, stream_pair_actions,
    stream_pair_actions_replay, top_n_batch_writer, watermarked, with_refreshed_dim,
)
