"""Getting one mapping out of a model's answer, as JSON; runs in an Arrow UDF, as Spark has no YAML parser."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import yaml
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from palisade import constants as C

LOADER = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
DUMPER = getattr(yaml, "CSafeDumper", yaml.SafeDumper)
_FENCE = re.compile(r"```(?:yaml)?\s*\n?(.*?)\n?\s*```", re.S | re.I)
_SCALAR = re.compile(rf"^({'|'.join(C.QUOTED_SCALARS)}):\s+(.+)$")
_ITEM = re.compile(r"^(\s*-\s+)(.+)$")


def _quoted(value: str) -> str:
    return '"' + value.replace("\\", "\\\\").replace('"', '\\"') + '"'


def _by_line(text: str, fix) -> str:
    return "\n".join(map(fix, text.splitlines()))


def quote_scalars(text: str) -> str:
    """Quotes known one-line scalars that hold a colon."""

    def fix(line: str) -> str:
        m = _SCALAR.match(line)
        value = m[2].strip() if m else ""
        loose = m and value[0] not in "\"'" and (": " in value or value.endswith(":"))
        return f"{m[1]}: {_quoted(value)}" if loose else line

    return _by_line(text, fix)


def reads_as_flow(value: str) -> bool:
    if any(mark in value for mark in C.CODE_MARKS):
        return False
    try:
        yaml.load(value, LOADER)
    except yaml.YAMLError:
        return False
    return True


def quote_items(text: str) -> str:
    """Quotes list items that begin like flow style but are code."""

    def fix(line: str) -> str:
        m = _ITEM.match(line)
        return m[1] + _quoted(m[2]) if m and m[2][0] in C.FLOW_STARTS and not reads_as_flow(m[2].strip()) else line

    return _by_line(text, fix)


REPAIRS = (
    lambda s: s,
    lambda s: s.replace("\t", "  "),
    lambda s: re.sub(r",(\s*[\]}])", r"\1", s),
    quote_scalars,
    quote_items,
    lambda s: quote_items(quote_scalars(s)),
)


def as_mapping(doc: object) -> dict | None:
    """A non-empty mapping, or a list of mappings made one: lists united, other values the first ones."""
    if isinstance(doc, dict):
        return doc or None
    out: dict = {}
    for item in doc if isinstance(doc, list) else ():
        for k, v in item.items() if isinstance(item, dict) else ():
            old = out.setdefault(k, v)
            if old is not v and isinstance(old, list) and isinstance(v, list):
                old += [x for x in v if x not in old]
            elif old is not v and isinstance(old, dict) and isinstance(v, dict):
                out[k] = {**v, **old}
    return out or None


def read_yaml(text: str) -> dict | None:
    """The first repair of the text that parses to a mapping."""
    tried = set()
    for repair in REPAIRS:
        fixed = repair(text)
        if not fixed.strip() or fixed in tried:
            continue
        tried.add(fixed)
        try:
            found = as_mapping(yaml.load(fixed, LOADER))
        except Exception:  # the parser's errors are of many kinds
            continue
        if found:
            return found
    return None


def regions(answer: str) -> Iterator[str]:
    """Where the document may be: in a fence, the whole answer, from the first known key, and that without its last lines."""
    if m := _FENCE.search(answer):
        yield m[1].strip()
    yield answer.strip()
    for key in C.ANCHOR_KEYS:
        at = answer.find(key + ":")
        if at >= 0:
            yield re.sub(r"```\s*$", "", answer[answer.rfind("\n", 0, at) + 1 :].strip()).strip()
            break
    bare = re.sub(r"\n?\s*```\s*$", "", re.sub(r"^```(?:yaml)?\s*\n?", "", answer.strip()))
    rows = bare.splitlines()
    for end in range(len(rows), max(len(rows) - C.TAIL_LINES, 0), -1):
        yield "\n".join(rows[:end]).strip()


def extract(answer: str | None) -> dict | None:
    return next((doc for r in regions(answer or "") if r and (doc := read_yaml(r))), None)


def texts(value: object) -> object:
    """Scalars as strings, so that 1.10 and dates stay what they look like to Python; nulls stay."""
    if isinstance(value, dict):
        return {str(k): texts(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [texts(v) for v in value]
    return value if value is None else str(value)


@F.pandas_udf(StringType())
def answer_json(answers: pd.Series) -> pd.Series:
    """JSON of the mapping in each answer, null where there is none."""
    found = (extract(a) for a in answers)
    return pd.Series([None if d is None else json.dumps(texts(d), ensure_ascii=False) for d in found], dtype=object)


@F.pandas_udf(StringType())
def file_json(files: pd.Series) -> pd.Series:
    """JSON of a YAML file as it is, null where it isn't valid."""

    def read(text: str) -> str | None:
        try:
            doc = as_mapping(yaml.load(text, LOADER))
        except Exception:
            return None
        return None if doc is None else json.dumps(texts(doc), ensure_ascii=False)

    return pd.Series([read(t) for t in files], dtype=object)


@F.pandas_udf(StringType())
def yaml_text(records: pd.Series) -> pd.Series:
    """YAML of JSON records, keys in their order."""
    return records.map(lambda r: yaml.dump(json.loads(r), Dumper=DUMPER, sort_keys=False, allow_unicode=True))
