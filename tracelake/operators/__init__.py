"""DataFrame → DataFrame operators."""

from tracelake.operators.cells import cell_dimension, tower_cities  # noqa: F401
from tracelake.operators.itineraries import (  # noqa: F401
    city_visits,
    daily_itineraries,
    distinct_pairs,
    itineraries,
)
from tracelake.operators.lookup import (  # noqa: F401
    answer_requests,
    lookup_batch,
    lookup_by_range,
    lookup_itineraries,
    lookup_one,
    rejected_requests,
    validate_requests,
)
from tracelake.operators.metrics import (  # noqa: F401
    accuracy,
    accuracy_of_counts,
    confusion_counts,
    confusion_matrix,
    matrix_of_counts,
)
from tracelake.operators.regions import (  # noqa: F401
    assemble_coordinate,
    coordinate_array,
    encode_regions,
    forest_partitions,
    predict,
    prepare_places,
    province_labels,
    fit_regions,
    split_by_key,
    split_flag,
    train_region_model,
)
