"""Where the files of one table lie."""

from __future__ import annotations

from datetime import date

MODES = ("glob", "tree", "dated")


def resolve_paths(
    base: str,
    table: str,
    mode: str,
    day: date | None = None,
    folder: str = "",
    compact: bool = False,
) -> str:
    """Path of a table's files below ``base``.

    ``glob``   files ``<table>*.csv`` in the table's folder
    ``tree``   the whole tree of the table, as fact tables need
    ``dated``  the ``yyyy/MM/dd`` folder of one day, as reference tables need;
               ``yyyyMMdd`` if ``compact``, as result folders are named

    ``folder`` names a folder inside the table's, such as a profile area.
    """
    root = "/".join(part.strip("/") for part in (table, folder) if part.strip("/"))
    root = f"{base.rstrip('/')}/{root}"
    if mode == "glob":
        return f"{root}/{table}*.csv"
    if mode == "tree":
        return root
    if mode == "dated":
        if day is None:
            raise ValueError("mode 'dated' needs a day")
        return f"{root}/{day:%Y%m%d}" if compact else f"{root}/{day:%Y/%m/%d}"
    raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def table_mode(table: str, fact_tables: set[str]) -> str:
    """Fact tables are read as a whole tree, all others from one day's folder."""
    known = {name.lower() for name in fact_tables}
    return "tree" if table.lower() in known else "dated"
