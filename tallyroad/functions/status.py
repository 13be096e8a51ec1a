"""Delivery status codes, metrics and key labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The driver metric each status code counts towards.
STATUS_METRIC = {
    "400": "sign_driver",
    "800": "run_driver",
    "900": "complete_driver",
    "450": "exception_driver",
    "500": "exception_driver",
    "600": "exception_driver",
    "950": "exception_driver",
}
METRICS = ("sign_driver", "run_driver", "exception_driver", "complete_driver")
PRICED_STATUS = "900"
PRICED_METRIC = STATUS_METRIC[PRICED_STATUS]


def metric_of(status: Column) -> Column:
    """Metric name of a status, NULL when it counts towards none."""
    codes: dict[str, list[str]] = {}
    for code, metric in STATUS_METRIC.items():
        codes.setdefault(metric, []).append(code)
    result = None
    for metric, members in codes.items():
        hit = status.isin(*members)
        result = F.when(hit, metric) if result is None else result.when(hit, metric)
    return result


def key_label(*parts: Column) -> Column:
    """Parts joined by ``@``; joins and groupings use the real columns."""
    return F.concat_ws("@", *parts)


def key_part(label: Column, index: int) -> Column:
    """Part ``index`` of a key label, NULL when it has fewer parts."""
    return F.get(F.split(label, "@"), F.lit(index))
