from meterline.functions.columns import (  # noqa: F401
    clip,
    cut,
    cut_code,
    half_up,
    md5_bucket,
    md5_key,
    nan_to_null,
    seconds_between,
)
from meterline.functions.geo import bearing, haversine, manhattan  # noqa: F401
