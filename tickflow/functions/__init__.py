from tickflow.functions.scalars import (
    alert_key,
    alert_line,
    arrival_number,
    event_instant,
    finite,
    number,
    number_text,
    order_key,
    percent_change,
    ratio,
    strict_number,
    utf8,
)

__all__ = [
    "alert_key",
    "alert_line",
    "arrival_number",
    "event_instant",
    "finite",
    "number",
    "number_text",
    "order_key",
    "percent_change",
    "ratio",
    "strict_number",
    "utf8",
]
