"""JSON access on decoded metric maps.

JSON objects are decoded once into ``map<string,string>`` with ``from_json``:
key existence is ``map_contains_key`` (true for a JSON null too), and a missing or
malformed object is NULL. ``from_json`` keeps every occurrence of a repeated key and
lookups find the first; ``keep_last`` makes the last one count.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetspark.functions.util import col_of

MAP_SCHEMA = "map<string,string>"


def decode_object(c) -> Column:
    """JSON text -> map; NULL when the text is not a JSON object."""
    return F.from_json(col_of(c), MAP_SCHEMA)


def keep_last(m: Column) -> Column:
    """The map with the last value of each repeated key (``m`` should be a parsed column)."""
    keys, values = F.map_keys(m), F.map_values(m)
    once = F.array_distinct(keys)
    last = F.map_from_arrays(once, F.transform(once, lambda k: F.element_at(F.reverse(values), F.array_position(F.reverse(keys), k).cast("int"))))
    return F.when(F.size(once) < F.size(keys), last).otherwise(m)


def has_metric(key: str, metrics="metrics") -> Column:
    """``metrics ? key``."""
    return F.map_contains_key(col_of(metrics), F.lit(key))


def metric_text(key: str, metrics="metrics") -> Column:
    """``metrics ->> key`` (NULL when absent)."""
    return F.try_element_at(col_of(metrics), F.lit(key))


def metric(key: str, metrics="metrics", dtype: str = "double") -> Column:
    """``(metrics ->> key)::numeric``; non-numeric text gives NULL."""
    return metric_text(key, metrics).try_cast(dtype)


def json_path(c, *keys: str) -> Column:
    """P10: ``c -> k1 -> k2 ->> kn``; keys may contain dots (``pd.soc``)."""
    path = "$" + "".join("['" + k.replace("'", "\\'") + "']" for k in keys)
    return F.get_json_object(col_of(c), path)

