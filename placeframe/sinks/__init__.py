from placeframe.sinks.writers import (  # noqa: F401
    assert_published,
    encode_json_lines,
    files_per_partition,
    land_dated_json,
    land_dated_lines,
    land_lines,
    land_period_json,
    materialize,
    preview,
    publish_zone,
    write_partitioned_parquet,
    write_table,
)
from placeframe.sinks.layout import layout_record, layout_report, listed_layout, write_fixed_layout  # noqa: F401
from placeframe.sinks.publish import assert_files_published, content_manifest, diff_manifests, file_counts, publish_files  # noqa: F401
from placeframe.sinks.versions import current_version, publish_version, read_version  # noqa: F401
