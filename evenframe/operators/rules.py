"""Which statistics a field gets, by the type its data dictionary states.

Two families of dictionaries are known: ``erp`` with exact type names and a
number of decimals, and ``crm`` with type labels such as ``Number(18, 2)``.
The *target* side is the copy under test, the *source* side the system it came
from; the two sides differ in a few statistics.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable
from dataclasses import dataclass

log = logging.getLogger(__name__)

SUM_LEN, COUNT_DISTINCT, SUM = "SUM_LEN", "COUNT_DISTINCT", "SUM"
SIDES = ("target", "source")

# Type names of the erp dictionary.
ERP_TEXT = {
    "CHAR", "VARCHAR", "STRING", "NUMC", "RAW", "LRAW", "BOOL", "CUKY", "CLNT",
    "UNIT", "LANG",
}
ERP_NUMBER = {"DEC", "QUAN", "INT1", "INT2", "INT4", "INT8", "FLTP", "CURR"}
ERP_TIME = {"DATS", "TIMS", "SECONDDATE"}
ERP_PRECISION = 30

# Words looked for, without case, in the labels of the crm dictionary.
CRM_TEXT = (
    "Email", "picklist", "Phone", "text", "Url", "Address", "Combobox", "Id", "Lookup",
)
CRM_FLAG = ("Boolean", "Checkbox")
CRM_FORMULA = {
    "Formula (Percent)", "Formula (Currency)", "Formula (Number)", "Formula (Double)",
}
CRM_NUMBER = ("Percent", "Currency", "Number", "Double")
CRM_TIME = ("Time", "DateTime")
CRM_DATE = ("Date",)
CRM_FORMULA_TYPE = (30, 2)
TIME_CHARACTERS, DATE_CHARACTERS = 19, 10

# Column with the time of the last change, per dictionary family.
CHANGE_COLUMN = {"erp": "EDW_MDF_TST", "crm": "SystemModstamp"}


@dataclass(frozen=True)
class Statistic:
    """One aggregate over one field; ``kind`` is also the prefix of its name."""

    kind: str
    field: str
    first: int | None = None  # SUM_LEN: count only the first characters
    decimal: tuple[int, int] | None = None  # SUM: result type
    flag: bool = False  # SUM: True/False texts count as 1/0

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.field}"


def erp_statistics(field: str, data_type: str | None, decimals: int | None, side: str):
    """Statistics by exact type name; both sides give equal numbers."""
    length, distinct = Statistic(SUM_LEN, field), Statistic(COUNT_DISTINCT, field)
    if data_type in ERP_TEXT:
        return [length, distinct]
    if data_type in ERP_NUMBER:
        return [Statistic(SUM, field, decimal=(ERP_PRECISION, int(decimals or 0)))]
    if data_type in ERP_TIME:
        return [distinct, length]
    return [distinct]


def crm_statistics(field: str, label: str | None, side: str):
    """Statistics by what the type label contains; the first match wins."""
    length, distinct = Statistic(SUM_LEN, field), Statistic(COUNT_DISTINCT, field)
    target = side == "target"
    if label is None:
        log.warning("field %s has no data type, only its distinct values count", field)
        return [distinct]
    if _mentions(label, CRM_TEXT):
        return [length, distinct]
    if _mentions(label, CRM_FLAG):
        return [Statistic(SUM, field, flag=target), distinct]
    if target and label in CRM_FORMULA:
        return [Statistic(SUM, field, decimal=CRM_FORMULA_TYPE)]
    if _mentions(label, CRM_NUMBER):
        if not target:
            return [Statistic(SUM, field)]
        return [Statistic(SUM, field, decimal=label_precision(field, label))]
    if _mentions(label, CRM_TIME):
        return [distinct, Statistic(SUM_LEN, field, TIME_CHARACTERS if target else None)]
    if _mentions(label, CRM_DATE):
        return [distinct, Statistic(SUM_LEN, field, DATE_CHARACTERS if target else None)]
    return [distinct]


def label_precision(field: str, label: str) -> tuple[int, int]:
    """``(18, 2)`` out of ``Number(18, 2)``; a bare label is an error."""
    found = re.search(r"\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", label)
    if not found:
        raise ValueError(f"field {field}: number label {label!r} states no precision")
    return int(found[1]), int(found[2] or 0)


def _mentions(label: str, words: Iterable[str]) -> bool:
    lowered = label.lower()
    return any(word.lower() in lowered for word in words)
