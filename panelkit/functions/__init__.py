from panelkit.functions.missing import (  # noqa: F401
    least_strict,
    member_of,
    nan_to_null,
    ratio_or_zero,
    sum_strict,
    sum_zero,
    to_number,
    weighted_mean,
)
from panelkit.functions.labels import (  # noqa: F401
    extract_groups,
    file_stem,
    in_years,
    is_relative_unit,
    pick,
    recode,
    recoded_to,
    weight_choice,
)
