"""Inputs: parquet tables, text lines (batch and file stream), sequences."""

from keyflow.sources.sequence import sequence
from keyflow.sources.tables import (clicks, employees, integers, numbers, profit, rules,
                                    sales, table, timed, trips)
from keyflow.sources.text import read_lines, to_lines

__all__ = ["table", "profit", "sales", "timed", "numbers", "clicks", "trips", "employees",
           "rules", "integers", "read_lines", "to_lines", "sequence"]
