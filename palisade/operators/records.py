"""From parsed responses to records of one fixed schema."""

from __future__ import annotations

import json
from functools import lru_cache, reduce

import pandas as pd
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from palisade import constants as C
from palisade.functions.indicators import as_list, distinct_ignoring_case, fang, labelled, normalize_hashes, placeholder, reserved_ip, strip_markdown_link, without_placeholders
from palisade.functions.text import corrupt_title

NONE = "cast(array() as array<string>)"


def _names(field: str) -> tuple[str, ...]:
    return (field, *C.OLD_NAMES.get(field, ()), *C.MORE_NAMES.get(field, ()))


def _values(field: str, container: str | None = None) -> str:
    """SQL of the values (array<variant>) that a field's names have: those in the containers if there are any, else at the top."""
    there = lambda of: "filter(array(" + ", ".join(of) + "), v -> v is not null and not is_variant_null(v))"
    top = there([f"_m['{n}']" for n in _names(field)])
    if container is None:
        return top
    inside = there([f"coalesce({container}[0]['{n}'], {container}[1]['{n}'])" for n in _names(field)])
    return f"get(transform(array({inside}), x -> if(size(x) > 0, x, {top})), 0)"


def _strings(value: Column) -> Column:
    """A list's strings, null of what isn't a list; objects as JSON."""
    return F.filter(F.try_variant_get(value, "$", "array<string>"), lambda x: x.isNotNull() & (F.trim(x) != ""))


def _united(values: Column) -> Column:
    """The list of a field: of its first name's value, with what the lists of its other names have beyond it; strings are read as lists."""
    text = F.try_variant_get(F.get(values, 0), "$", "string")
    lists = F.filter(F.transform(values, _strings), lambda x: x.isNotNull())
    more = lambda xs: F.concat(F.get(xs, 0), F.array_except(F.flatten(F.slice(xs, 2, 100)), F.get(xs, 0)))
    # within a list of one, so that it is made once
    joined = F.get(F.transform(F.array(lists), lambda xs: F.when(F.size(xs) > 0, more(xs))), 0)
    json_list = F.filter(F.from_json(text, "array<string>"), lambda x: x.isNotNull() & (F.trim(x) != ""))
    parsed_text = F.coalesce(F.when(F.startswith(F.ltrim(text), F.lit("[")), json_list), as_list(text))
    return F.when(F.size(values) == 0, F.expr(NONE)).when(_strings(F.get(values, 0)).isNotNull(), joined).otherwise(parsed_text)


def _scalar(values: Column) -> Column:
    first = F.get(values, 0)
    return F.coalesce(F.array_join(_strings(first), " "), F.trim(F.try_variant_get(first, "$", "string")), F.lit(""))


#: Fields in the order of the lists that are made at once, and the columns of their containers.
_LISTS = (*[(f, "_t") for f in C.TTP_FIELDS], *[(f, None) for f in C.TOP_LISTS], *[(f, "_i") for f in C.IOC_FIELDS])
_KNOWN = sorted({n for f in (*C.TTP_FIELDS, *C.IOC_FIELDS, *C.TOP_LISTS, *C.TOP_SCALARS, "ttps", "iocs") for n in _names(f)})
#: How items of a flat list of indicators are told apart, in SQL over v.
_FITS = {
    "hashes": f"v rlike r'(?i){C.HASH_PATTERN}'",
    "ip_addresses": r"replace(v, '[.]', '.') rlike r'^\s*(?:\d{1,3}\.){3}\d{1,3}'",
    "domains": r"replace(v, '[.]', '.') rlike r'(?i)^\s*(?:[a-z0-9-]+\.)+[a-z]{2,}\s*$'",
    "urls": rf"v rlike r'(?i)(?:https?|hxxps?)(?:://|\[:\])' and not v rlike r'(?i){C.HASH_PATTERN}'",
}


@lru_cache(maxsize=1)
def _steps(_gateway: object) -> list[list[Column]]:
    """The columns of each step of normalize; the same for all documents, so they are put together once a JVM."""
    as_map = lambda v: f"try_variant_get({v}, '$', 'map<string,variant>')"
    both = lambda f: "array(" + ", ".join(as_map(f"_m['{n}']") for n in _names(f)[:2]) + ")"
    flat = F.coalesce(_strings(F.expr("get(" + _values("iocs") + ", 0)")), F.expr(NONE))
    own = len(_LISTS) - len(C.IOC_FIELDS)
    joined = [f"concat(_lists[{own + i}], filter(_flat, v -> {_FITS[f]}))" for i, f in enumerate(C.IOC_FIELDS)]
    m, s = F.col("_m"), F.col("_s")
    at = {f: F.col("_lists")[i] for i, (f, _) in enumerate(_LISTS)}
    title, attribution = F.col("_s")[C.TOP_SCALARS.index("title")], F.col("_s")[C.TOP_SCALARS.index("attribution")]
    iocs = {"hashes": normalize_hashes(at["hashes"]), **{f: F.col("_distinct")[i] for i, f in enumerate(("ip_addresses", "domains", "urls"))}}
    return [
        [F.expr(as_map("_v")).alias("_m")],
        [m, F.expr(both("ttps")).alias("_t"), F.expr(both("iocs")).alias("_i"), F.array(*[F.expr(_values(f)) for f in C.TOP_SCALARS]).alias("_s")],
        [m, s, F.array(*[F.expr(_values(f, c)) for f, c in _LISTS]).alias("_raw"), flat.alias("_flat")],
        [m, F.transform("_s", _scalar).alias("_s"), F.transform("_raw", _united).alias("_lists"), F.col("_flat")],
        [m, s, F.expr(f"concat(slice(_lists, 1, {own}), array({', '.join(joined)}))").alias("_lists")],
        [m, s, F.transform("_lists", lambda xs: F.transform(without_placeholders(xs), strip_markdown_link)).alias("_lists")],
        [m, s, F.col("_lists"), F.filter(at["ip_addresses"], lambda v: ~reserved_ip(v)).alias("_ips")],
        [m, s, F.col("_lists"), F.transform(F.array("_ips", at["domains"], at["urls"]), distinct_ignoring_case).alias("_distinct")],
        [
            F.when(corrupt_title(title), "").otherwise(title).alias("title"),
            F.col("_s")[C.TOP_SCALARS.index("description")].alias("description"),
            F.when(placeholder(attribution), "").otherwise(attribution).alias("attribution"),
            *[at[f].alias(f) for f in C.TOP_LISTS],
            F.struct(*[at[f].alias(f) for f in C.TTP_FIELDS]).alias("ttps"),
            F.struct(*[iocs[f].alias(f) for f in C.IOC_FIELDS]).alias("iocs"),
            F.expr(f"to_variant_object(map_filter(_m, (k, v) -> k not in ({', '.join(map(repr, _KNOWN))})))").alias("extras"),
        ],
    ]


def normalize(docs: DataFrame, document: str = "document") -> DataFrame:
    """docs with the JSON text in `document` replaced by the canonical columns.

    Old names are mapped: lists under several names of a field are united, of other values the first name's counts; so
    are the containers' keys. Misplaced fields are moved where they aren't in place as well; lists and scalars are
    coerced, then titles checked, placeholders taken out, links stripped, hashes, addresses and lists normalised, in this
    order. Indicators in a flat list are sorted by kind. Keys beyond the schema stay in `extras`, a VARIANT. Nulls count
    as absent. A document is parsed once, each field's list is made by one expression over all of them.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c != document]
    step = docs.select(*keep, F.try_parse_json(F.col(document)).alias("_v"))
    for columns in _steps(SparkContext._gateway):
        step = step.select(*keep, *columns)
    return step


def merged_extras(documents: list[str | None]) -> str:
    """One JSON object of the keys beyond the schema, from an article's chunks in order.

    Empty values never replace any. Of scalars the first stays, lists are joined without repeats, in objects a later
    scalar replaces an earlier one.
    """
    out: dict = {}
    for text in documents:
        for key, value in (json.loads(text) if text else {}).items():
            old = out.get(key)
            if value in (None, "", [], {}):
                continue
            if old in (None, "", [], {}):
                out[key] = value
            elif isinstance(old, list) and isinstance(value, list):
                out[key] = old + [v for i, v in enumerate(value) if v not in old and v not in value[:i]]
            elif isinstance(old, dict) and isinstance(value, dict):
                for name, inner in value.items():
                    if inner in (None, "", [], {}):
                        continue
                    both = isinstance(old.get(name), list) and isinstance(inner, list)
                    old[name] = old[name] + [v for v in inner if v not in old[name]] if both else inner
    return json.dumps(out, ensure_ascii=False)


@F.pandas_udf(StringType())
def merge_extras(documents: pd.Series) -> pd.Series:
    return documents.map(lambda xs: merged_extras(list(xs)))


def merge_records(records: DataFrame, key: str, order: str) -> DataFrame:
    """One canonical record a key from its chunks' records, in order; what is beyond the schema is merged in `extras`."""
    from palisade.operators.merge import fold_chunks

    flat = records.select(
        key, order, *C.TOP_SCALARS, *C.TOP_LISTS, F.array(F.to_json("extras")).alias("extras"),
        *[F.col(f"ttps.{f}").alias(f"ttps_{f}") for f in C.TTP_FIELDS], *[F.col(f"iocs.{f}").alias(f"iocs_{f}") for f in C.IOC_FIELDS],
    )
    lists = (*C.TOP_LISTS, *[f"ttps_{f}" for f in C.TTP_FIELDS], *[f"iocs_{f}" for f in C.IOC_FIELDS])
    m = fold_chunks(flat, key, order, first=("title", "attribution"), longest=("description",), lists=(*lists, "extras"))
    tidy = lambda f: F.col(f"iocs_{f}") if f == "hashes" else distinct_ignoring_case(F.col(f"iocs_{f}"))
    return m.select(
        key, "n_chunks", *C.TOP_SCALARS, *C.TOP_LISTS,
        F.struct(*[F.col(f"ttps_{f}").alias(f) for f in C.TTP_FIELDS]).alias("ttps"), F.struct(*[tidy(f).alias(f) for f in C.IOC_FIELDS]).alias("iocs"),
        F.parse_json(merge_extras("extras")).alias("extras"),
    )


def meaningful(ttps: list[Column], iocs: list[Column], cves: Column, attribution: Column, families: Column) -> Column:
    """Any behaviour, indicator or CVE, or an actor together with a malware family."""
    some = reduce(lambda a, b: a | b, [F.coalesce(F.size(x), F.lit(0)) > 0 for x in [*ttps, *iocs, cves]])
    return some | ((F.trim(F.coalesce(attribution, F.lit(""))) != "") & (F.coalesce(F.size(families), F.lit(0)) > 0))


def record_is_meaningful() -> Column:
    return meaningful([F.col(f"ttps.{f}") for f in C.TTP_FIELDS], [F.col(f"iocs.{f}") for f in C.IOC_FIELDS], F.col("cves"), F.col("attribution"), F.col("malware_families"))


def enrich(records: DataFrame, reference: str, published: Column, created: Column) -> DataFrame:
    return records.withColumns({"reference": F.col(reference), "date_of_publication": published, "file_creation_date": created})


def parsed(rows: DataFrame, raw: str, schema: str) -> DataFrame:
    """rows with `value` parsed from the JSON in `raw` and `dead`: whether it couldn't be. Dead letters keep their raw text."""
    value = F.from_json(raw, schema, {"mode": "PERMISSIVE"})
    dead = F.try_parse_json(F.col(raw)).isNull()
    return rows.withColumns({"value": F.when(~dead, value), "dead": dead})


def indicators(records: DataFrame, key: str = "reference") -> DataFrame:
    """key, kind, value, value_fanged, family: one row an indicator, with a form in which defanged twins are equal."""
    found = F.flatten(F.array(*[labelled(f, F.col(f"iocs.{f}")) for f in C.IOC_FIELDS]))
    return records.select(key, F.get("malware_families", 0).alias("family"), F.inline(found)).withColumn("value_fanged", F.lower(fang(F.col("value"))))


def edges(records: DataFrame, key: str = "reference") -> DataFrame:
    """key, kind, src, dst, port: process relations and network connections split into their ends."""
    made = F.concat(*[labelled(f, F.col(f"ttps.{f}")) for f in ("process_relations", "network_connections")])
    e = records.select(key, F.inline(made)).withColumn("ends", F.split("value", r"\s*->\s*", 2)).where(F.size("ends") == 2)
    port = F.when(F.col("kind") == "network_connections", F.regexp_extract(F.col("ends")[1], r":(\d{1,5})$", 1).try_cast("int"))
    end = F.col("ends")[1]
    dst = F.when(port.isNotNull(), F.regexp_replace(end, r":\d{1,5}$", "")).otherwise(end)
    return e.select(key, "kind", F.trim(F.col("ends")[0]).alias("src"), dst.alias("dst"), port.alias("port"))


def schema_json() -> str:
    """The canonical record as JSON, empty; for prompts and tests."""
    return json.dumps({**dict.fromkeys(C.TOP_SCALARS, ""), **{f: [] for f in C.TOP_LISTS}, "ttps": {f: [] for f in C.TTP_FIELDS}, "iocs": {f: [] for f in C.IOC_FIELDS}})
