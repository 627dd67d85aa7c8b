from dealerlake.functions.bands import invoice_bucket, outside_price_classes, price_class, service_priority
from dealerlake.functions.clean import moment, parse_birth_date, parse_price, to_millis

__all__ = [
    "invoice_bucket",
    "moment",
    "outside_price_classes",
    "parse_birth_date",
    "parse_price",
    "price_class",
    "service_priority",
    "to_millis",
]
