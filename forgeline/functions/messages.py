"""Message texts as column expressions: a template of ``config`` with its
placeholders filled by columns (data) or Python values (parameters)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def message(template: str, **values) -> Column:
    """``template`` with each ``{name}`` replaced by ``values[name]``: a
    Column is inserted as text, anything else is formatted in Python."""
    parts = []
    pos = 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        v = values[m.group(1)]
        parts.append(v.cast("string") if isinstance(v, Column) else F.lit(str(v)))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if len(parts) > 1 else parts[0]
