"""Date and time text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Percent codes and the patterns that mean the same.
CODES = {"Y": "yyyy", "y": "yy", "m": "MM", "c": "M", "d": "dd", "e": "d", "H": "HH", "k": "H", "h": "hh", "I": "hh", "l": "h", "i": "mm", "S": "ss", "s": "ss", "f": "SSSSSS", "p": "a", "M": "MMMM", "b": "MMM", "W": "EEEE", "a": "EEE", "j": "DDD", "T": "HH:mm:ss"}


def pattern(codes: str) -> str:
    """The datetime pattern for percent codes; an unknown code raises."""
    out = []
    for code, text in re.findall(r"%(.)|([^%]+)", codes):
        if not code:
            out.append(re.sub(r"([A-Za-z]+)", r"'\1'", text.replace("'", "''")))
        elif code == "%":
            out.append("%")
        elif code in CODES:
            out.append(CODES[code])
        else:
            raise ValueError(f"date code %{code} has no equivalent")
    return "".join(out)


def date_format(when: Column, codes: str) -> Column:
    return F.date_format(when, pattern(codes))
