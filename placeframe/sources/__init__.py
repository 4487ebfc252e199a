from placeframe.sources.readers import (  # noqa: F401
    create_external_json_table,
    decode_json_lines,
    file_manifest,
    latest_snapshot,
    page_record_lines,
    paged_records,
    read_json_lines,
    read_latest_partition,
    read_locations,
    read_ndjson,
    read_partitioned,
    read_weather,
    staged_page_lines,
)
from placeframe.sources.zones import latest_day, read_day_window  # noqa: F401
