from roadwatch.sinks.keyed import KeyedTable, counter_table, track_table
from roadwatch.sinks.writers import (
    append_violations_once_per_day, latest_tracks, split_outcomes, upsert_counts,
    violations_to_insert, write_console, write_lines_kafka, write_table, write_tracks,
)
