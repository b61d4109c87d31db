from roadwatch.sources.derived import (
    Tables, monitors_from_supplier, passages_from_events, police_actions_from_events,
    violations_from_events,
)
from roadwatch.sources.lines import (
    parse_passages, parse_police_actions, parse_violations, read_lines, read_lines_stream, to_lines,
)
from roadwatch.sources.tables import one_row_per_station, read_monitors, read_violations
