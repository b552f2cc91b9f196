"""JSON validity of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRICT = {"allowSingleQuotes": "false"}


def is_json(text: Column) -> Column:
    """True when ``text`` is exactly one JSON value, by the rules of common JSON readers.

    Spark's parsers stop after the first value and ignore what follows it. The text is
    therefore read as the first element of an array whose second is the text's own hash:
    the hash is found there only if the text is one value and nothing else.

    ``try_parse_json`` refuses duplicate keys and ``NaN``, which JSON readers commonly take.
    Only texts that fail it are tried again with ``from_json``, inside an array and inside
    an object: what may follow the value in one of them is an error in the other.
    """
    mark = F.xxhash64(text)
    marked = F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]"))
    plain = F.try_variant_get(F.try_parse_json(marked), "$[1]", "bigint") == mark

    in_array = F.concat(F.lit("["), text, F.lit("]"))
    in_object = F.concat(F.lit('{"v":'), text, F.lit("}"))
    lenient = (
        F.from_json(in_array, "array<map<string,string>>", _STRICT).isNotNull()
        & F.from_json(in_object, "struct<v:map<string,string>>", _STRICT)["v"].isNotNull()
    )
    return F.when(plain, F.lit(True)).otherwise(F.coalesce(lenient, F.lit(False)))
