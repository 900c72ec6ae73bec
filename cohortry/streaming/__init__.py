from cohortry.streaming.events import (
    clean_event_stream,
    closed_windows,
    live_monitor,
    merge_events,
    merge_stream,
    merged_events,
    read_event_stream,
    run_to_table,
    windowed_arm_counts,
)

__all__ = [
    "clean_event_stream",
    "closed_windows",
    "live_monitor",
    "merge_events",
    "merge_stream",
    "merged_events",
    "read_event_stream",
    "run_to_table",
    "windowed_arm_counts",
]
