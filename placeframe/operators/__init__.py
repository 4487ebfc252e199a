from placeframe.operators.aggregates import (  # noqa: F401
    count_over_time,
    density_correlation,
    dominant_category,
    geocode_coverage,
    join_coverage,
    latest_per_key,
    lookup_report,
    top_groups,
)
from placeframe.operators.clean import (  # noqa: F401
    clean_locations,
    filter_country,
    filter_geocoded,
    filter_required,
    flatten_weather,
)
from placeframe.operators.joins import (  # noqa: F401
    assemble_weather,
    daily_arrays,
    left_join_weather,
    missing_weather,
    trailing_window,
)
from placeframe.operators.marts import (  # noqa: F401
    dim_locations,
    enrich,
    fact_location_weather,
    stg_locations,
    state_weather_summary,
)
from placeframe.operators.quality import (  # noqa: F401
    check_accepted_values,
    check_not_null,
    check_unique,
    require_nonempty,
    run_suite,
)
