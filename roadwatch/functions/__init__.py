from roadwatch.functions.columns import (
    DEFAULT_LIMIT, OVERSPEED_FACTOR, SEVERE_FACTOR, DAY_MS, day_start_ms, millis_to_ts,
    newest_first_key, overspeed, rounded_average, severe_overspeed, ts_to_millis,
)
