from keelson.functions.columns import (  # noqa: F401
    as_col,
    bin_index,
    bin_of,
    hash_bucket,
    hash_unit,
    logistic,
    safe_ratio,
)
