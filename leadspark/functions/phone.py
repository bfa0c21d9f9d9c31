from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import CALLING_CODES
from .text import col, quoted

_CODE_OF = {r: c for c, r in CALLING_CODES.items()}


def parse_phone(phone: Column | str, region: Column | str | None = None) -> Column:
    """struct(e164, country, valid) of a phone as typed.

    Scope: numbers with +, 00 or, if a region is given, in national form (a leading 0 is dropped, except in Italy). The national
    number must have 6 to 13 digits and the whole at most 15; no numbering plan is consulted. What has digits but is none of
    these comes out as typed digits with valid false; what has no digits is null."""
    t = F.regexp_replace(F.trim(col(phone).cast("string")), r"\(0\)", "")
    digits = F.regexp_replace(t, r"[^0-9]", "")
    plus, zeros = F.startswith(F.regexp_replace(t, r"^[(\s]+", ""), F.lit("+")), F.startswith(digits, F.lit("00"))
    home = (col(region) if region is not None else F.lit(None)).cast("string")
    code = F.element_at(F.create_map(*[F.lit(x) for kv in _CODE_OF.items() for x in kv]), home)
    national = F.when(home == "IT", digits).otherwise(F.regexp_replace(digits, "^0", ""))
    whole = F.when(plus, digits).when(zeros, F.substring(digits, 3, 30)).when(code.isNotNull(), F.concat(code, national))
    prefix = F.nullif(F.regexp_extract(whole, rf"^({quoted(CALLING_CODES)})", 1), F.lit(""))
    country = F.element_at(F.create_map(*[F.lit(x) for kv in CALLING_CODES.items() for x in kv]), prefix)
    rest = F.length(whole) - F.length(prefix)
    valid = F.coalesce(prefix.isNotNull() & (rest >= 6) & (rest <= 13) & (F.length(whole) <= 15) & ~F.substring(whole, F.length(prefix) + 1, F.lit(30)).rlike(r"^(\d)\1+$"), F.lit(False))
    some = digits != ""
    return F.struct(F.when(some, F.concat(F.lit("+"), F.coalesce(whole, digits))).alias("e164"), F.when(some, F.coalesce(country, home)).alias("country"), (valid & some).alias("valid"))
