"""Column-level functions: parsers, text encoders, time helpers."""

from keyflow.functions.parse import (parse_click, parse_employee, parse_int, parse_keyed,
                                     parse_profit, parse_timed, parse_trip)
from keyflow.functions.text import tuple_text
from keyflow.functions.time import epoch_millis, from_epoch_millis, with_ingest_time

__all__ = ["parse_profit", "parse_timed", "parse_keyed", "parse_trip", "parse_click",
           "parse_employee", "parse_int", "tuple_text", "epoch_millis",
           "from_epoch_millis", "with_ingest_time"]
