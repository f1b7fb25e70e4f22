"""JSON out of model responses: fences, envelopes, truncation and salvage."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields after which a record rebuilt from field pairs ends.
ENDING_FIELDS = ("PageNumber", "CFR", "Deaths")
# A complete object with at most one level of nesting; a field pair.
OBJECT = re.compile(r"\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}", re.DOTALL)
PAIR = re.compile(r'"([^"]+)":\s*([^,\n}]+)(?:,|\s*[}\]])')
#: What the bare text of a value may be read as, the first that fits.
READINGS = (
    (re.compile(r"\d+"), int),
    (re.compile(r"(?=.*\d)\d*\.\d*"), float),
    (re.compile(r"(?i)true|false"), lambda v: v.lower() == "true"),
)
#: Whole strings, brackets and braces; a quote alone begins a string that never ends.
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{}"]', re.DOTALL)
_CLOSES = {"{": "}", "[": "]"}


def unfenced(c: Column) -> Column:
    """The text within the first code fence, else the text itself."""
    body = F.regexp_extract(c, r"(?s)```(?:json)?\s*\n?(.*?)```", 1)
    return F.when(body != "", F.trim(body)).otherwise(c)


def array_slice(c: Column) -> Column:
    """From the first ``[`` to the last ``]``; null without both."""
    found = F.regexp_extract(c, r"(?s)\[.*\]", 0)
    return F.when(found != "", found)


def array_closed(c: Column) -> Column:
    """Up to the last ``}`` from the first ``[`` on, and a closing bracket."""
    body = F.regexp_extract(c, r"(?s)\[.*\}", 0)
    return F.when(body != "", F.concat(body, F.lit("]")))


def records(c: Column, record: str) -> Column:
    """The records of a response: an array, an envelope of one, or one record.

    Tried in this order: as it is without its fence, its records or data field,
    from bracket to bracket, closed after the last whole record.
    """
    text = unfenced(c)
    parse = lambda x: F.from_json(x, f"array<{record}>")
    whole = F.when(F.ltrim(text).startswith("["), parse(text))
    envelope = F.coalesce(parse(F.get_json_object(text, "$.records")), parse(F.get_json_object(text, "$.data")))
    cut = F.when(~F.ltrim(text).startswith("{"), parse(array_slice(text)))
    return F.coalesce(whole, envelope, cut, parse(array_closed(text)))


def _loads(text: str):
    try:
        got = json.loads(text)
    except (json.JSONDecodeError, RecursionError):
        return None
    return got if isinstance(got, list) else [got]


def recover(response: str | None) -> tuple[str, list]:
    """(method, records): the first repair that gives any record.

    As it is without fences; brackets and braces closed; cut after the last
    brace; whole objects alone; objects rebuilt from field pairs.
    """
    text = (response or "").strip()
    fence = re.search(r"```(?:json)?\s*\n?(.*?)(?:```|\Z)", text, re.DOTALL)
    text = fence[1].strip() if fence else text
    if got := _loads(text):
        return "markdown_cleanup", got
    start = text.find("[")
    if start >= 0:
        body = text[start:]
        braces, brackets = max(0, body.count("{") - body.count("}")), max(0, body.count("[") - body.count("]"))
        for tail in ("}" * braces, "]" * brackets, "}" * braces + "]" * brackets):
            if tail and (got := _loads(body + tail)):
                return "truncated_array_fix", got
        last = body.rfind("}")
        if last >= 0 and (got := _loads(body[: last + 1] + "]")):
            return "truncated_object_fix", got
    if got := [x[0] for m in OBJECT.finditer(text) if (x := _loads(m[0]))]:
        return "complete_objects_extraction", got
    rebuilt = rebuilt_records(text)
    return ("aggressive_repair", rebuilt) if rebuilt else ("no_recovery_possible", [])


def rebuilt_records(text: str) -> list[dict]:
    """Objects out of loose field pairs; each ends with one of ENDING_FIELDS."""
    pairs = [(m[1], m[2].strip().strip('"')) for m in PAIR.finditer(text)]
    ends = [k + 1 for k, (name, _) in enumerate(pairs) if name in ENDING_FIELDS]
    edges = sorted({0, *ends, len(pairs)})
    return [{name: typed(value) for name, value in pairs[a:b]} for a, b in zip(edges, edges[1:])]


def typed(value: str):
    return next((read(value) for pattern, read in READINGS if pattern.fullmatch(value)), value)


def salvaged(text: str | None) -> str | None:
    """A cut response's JSON up to the last whole element of its first array.

    One pass over the brackets outside strings keeps what is open. Where all is
    closed the document ends, and what follows is left off; where the text ends
    earlier, or a bracket does not fit, it is cut after the last element that
    was closed in the first array, and what is open there is closed. Null if no
    element was.
    """
    start = re.search(r"[\[{]", text or "")
    if not start:
        return None
    open_, level, cut = [], None, None
    for m in _TOKEN.finditer(text, start.start()):
        mark = m[0]
        if mark in _CLOSES:
            open_.append(_CLOSES[mark])
            if mark == "[" and level is None:
                level = len(open_)
        elif mark == '"':
            break
        elif mark in "]}":
            if mark != open_.pop():
                break
            if not open_:
                return text[start.start() : m.end()]
            if level and len(open_) <= level:
                cut = (m.end(), "".join(reversed(open_)))
            if level and len(open_) < level:
                level = 0  # the array is closed: nothing behind it is an element
    return text[start.start() : cut[0]] + cut[1] if cut else None


def salvaged_column(c: Column) -> Column:
    @F.pandas_udf("string")
    def run(responses: pd.Series) -> pd.Series:
        return pd.Series([salvaged(r) for r in responses], dtype=object)

    return run(c)


def corrections(c: Column) -> Column:
    """The corrections of a response: (status, corrections, summary).

    ``corrections`` is an array of JSON texts, ``summary`` the JSON text of an
    object. A whole object is ``parsed``; members that are missing or of another
    type are empty. Of a broken one the array is ``salvaged`` up to its last
    whole element, and the summary says so; else ``failed``, with both empty.
    """
    clean = F.trim(unfenced(c))
    whole = F.when(clean.startswith("{"), F.try_parse_json(clean))
    rest = F.regexp_extract(clean, r'(?s)"corrections"\s*:\s*(\[.*)', 1)
    saved = salvaged_column(F.when(whole.isNull() & (rest != ""), rest))
    elements = lambda x: F.transform(F.from_json(x, "array<variant>"), lambda e: F.to_json(e))
    of_kind = lambda k, kind: F.when(F.schema_of_variant(F.variant_get(whole, f"$.{k}", "variant")).startswith(kind), F.to_json(F.variant_get(whole, f"$.{k}", "variant")))
    found = elements(F.coalesce(of_kind("corrections", "ARRAY"), saved))
    status = F.when(whole.isNotNull(), "parsed").when(found.isNotNull(), "salvaged").otherwise("failed")
    summary = F.coalesce(of_kind("summary", "OBJECT"), F.when(whole.isNull() & found.isNotNull(), '{"recovery_attempted":true}'), F.lit("{}"))
    return F.struct(status.alias("status"), F.coalesce(found, F.array().cast("array<string>")).alias("corrections"), summary.alias("summary"))


def recovered(c: Column) -> Column:
    """(method, n, records) of a response, by ``recover``."""

    @F.pandas_udf("method string, n long, records string")
    def run(responses: pd.Series) -> pd.DataFrame:
        found = [recover(r) for r in responses]
        return pd.DataFrame([(m, len(r), json.dumps(r, ensure_ascii=False)) for m, r in found], columns=["method", "n", "records"])

    return run(c)


def recovery_report(logs: DataFrame) -> DataFrame:
    """Failed long responses with the repair that works: (id, method, n, records)."""
    failed = logs.filter("NOT parsed_success AND length(raw_response) > 1000 AND raw_response NOT LIKE 'ERROR:%'")
    return failed.withColumn("_r", recovered(F.col("raw_response"))).select("id", F.length("raw_response").alias("response_length"), "_r.method", F.col("_r.n").alias("records_recovered"), "_r.records")
