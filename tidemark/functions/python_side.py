"""Functions that built-ins can't say, as Arrow-batched pandas UDFs: Unicode folding, open JSON, html structure."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

HIDDEN = frozenset({"script", "style", "template", "noscript"})
CELL_BREAKS = frozenset({"td", "th", "caption"})


def fold(text: str | None) -> str | None:
    return None if text is None else unicodedata.normalize("NFKC", text).casefold()


@F.pandas_udf(T.StringType())
def nfkc_casefold(text: pd.Series) -> pd.Series:
    return text.map(fold, na_action="ignore")


def canonical_json(text: str | None, strict: bool = True) -> str | None:
    """Sorted keys, no blanks, raw UTF-8. ``strict`` refuses NaN and infinities, the lenient profile writes them."""
    if text is None:
        return None

    def refuse(name: str):
        raise ValueError(f"{name} is not a JSON number")

    value = json.loads(text, parse_constant=refuse) if strict else json.loads(text)
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=not strict, default=str)


def _canonical_or_error(text: str | None, strict: bool) -> tuple[str | None, str | None]:
    try:
        return canonical_json(text, strict), None
    except (ValueError, RecursionError):
        return None, "not JSON"


CANONICAL = T.StructType([T.StructField("canonical", T.StringType()), T.StructField("error", T.StringType())])


@F.pandas_udf(CANONICAL)
def canonical_json_strict(text: pd.Series) -> pd.DataFrame:
    """Text as canonical JSON; where it is none, null and what is wrong. A null text has neither."""
    return pd.DataFrame([_canonical_or_error(t, True) for t in text], columns=CANONICAL.names)


@F.pandas_udf(CANONICAL)
def canonical_json_lenient(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_canonical_or_error(t, False) for t in text], columns=CANONICAL.names)


# Fixed values of the unit identity: which fields each hash binds, and which fields of a mixed unit's parts are position or annotation.
PROJECTED = ("applicability", "heading_path", "payload_kind", "quality_status", "semantic_key", "title")
STRUCTURAL = ("heading_path", "order_index", "payload_kind")
PART_LAYOUT = frozenset({"order", "heading_path", "local_heading", "applicability", "quality_status", "artifact_locator"})
PART_ANNOTATIONS = frozenset({"heading_path", "local_heading", "applicability", "quality_status"})


def unit_identity(fields: dict, payload: dict) -> tuple[str, str, str]:
    """Three sha256 identities of a unit: what it says, what a query sees of it beside that, and where it stands.

    A set of semantic keys that is the scalar key alone binds nothing more, nor do absent section keys. The parts of a mixed unit
    say what is left without position and annotation; their annotations are part of what a query sees.
    """
    projected = {name: fields.get(name) for name in PROJECTED}
    if fields.get("semantic_keys") not in (None, [fields.get("semantic_key")]):
        projected["semantic_keys"] = fields["semantic_keys"]
    if fields.get("section_keys") is not None:
        projected["section_keys"] = fields["section_keys"]
    if fields["payload_kind"] == "mixed":
        parts = payload.get("parts")
        if not parts or not isinstance(parts, list) or not all(isinstance(part, dict) for part in parts):
            raise ValueError("a mixed unit needs parts")

        def only(part: dict, wanted) -> dict:
            return {name: value for name, value in part.items() if wanted(name)}

        projected["mixed_part_annotations"] = {"parts": [only(part, PART_ANNOTATIONS.__contains__) for part in parts]}
        payload = only(payload, lambda name: name != "semantic_type") | {"parts": [only(part, lambda name: name not in PART_LAYOUT) for part in parts]}
    forms = {"payload": payload, "payload_kind": fields["payload_kind"]}, projected, {name: fields.get(name) for name in STRUCTURAL}
    dumped = (json.dumps(form, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False) for form in forms)
    return tuple("sha256:" + hashlib.sha256(text.encode()).hexdigest() for text in dumped)


IDENTITIES = T.StructType([T.StructField(name, T.StringType()) for name in ("content_hash", "query_projection_hash", "structure_hash", "error")])


@F.pandas_udf(IDENTITIES)
def unit_identities(fields: pd.Series, payload: pd.Series) -> pd.DataFrame:
    """Identities of units given as two JSON objects; where the payload is no object of its kind, nulls and an error."""

    def of(known: str, said: str | None) -> tuple:
        try:
            return (*unit_identity(json.loads(known), json.loads(said or "")), None)
        except (ValueError, AttributeError, RecursionError) as error:
            return None, None, None, str(error)

    return pd.DataFrame([of(k, s) for k, s in zip(fields, payload)], columns=IDENTITIES.names)


class _Visible(HTMLParser):
    """Collects visible text; cells are boundaries, each with its tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden: list[str] = []
        self.segments: list[tuple[str, list[str]]] = [("text", [])]
        self.row = 0
        self.rows: list[int] = [0]

    def _begin(self, kind: str) -> None:
        self.segments.append((kind, []))
        self.rows.append(self.row)

    def handle_starttag(self, tag, attrs):
        if tag in HIDDEN:
            self.hidden.append(tag)
        elif tag == "tr":
            self.row += 1
        elif tag in CELL_BREAKS:
            self._begin(tag)

    def handle_endtag(self, tag):
        if tag in HIDDEN and tag in self.hidden:
            while self.hidden and self.hidden.pop() != tag:
                pass
        elif tag in CELL_BREAKS or tag == "table":
            self._begin("text")

    def handle_data(self, data):
        if not self.hidden:
            self.segments[-1][1].append(data)

    def texts(self) -> list[tuple[str, int, str]]:
        found = ((kind, row, " ".join(" ".join(parts).split())) for (kind, parts), row in zip(self.segments, self.rows))
        return [(kind, row, text) for kind, row, text in found if text]


def _parsed(html: str | None) -> list[tuple[str, int, str]]:
    if not html:
        return []
    parser = _Visible()
    parser.feed(html)
    parser.close()
    return parser.texts()


def visible_text(html: str | None) -> str | None:
    return None if html is None else " ".join(text for _, _, text in _parsed(html))


def visible_segments(html: str | None) -> list[str] | None:
    return None if html is None else [text for _, _, text in _parsed(html)]


def cell_roles(html: str | None) -> list[dict] | None:
    """Table cells with a role: header for th, for the first of two cells in a row, and for a first row without numbers before rows with some."""
    if html is None:
        return None
    cells = [(kind, row, text) for kind, row, text in _parsed(html) if kind in ("td", "th")]
    rows: dict[int, list[tuple[str, str]]] = {}
    for kind, row, text in cells:
        rows.setdefault(row, []).append((kind, text))
    numeric = lambda text: any(c.isdigit() for c in text)
    two_columns = bool(rows) and all(len(found) == 2 for found in rows.values())
    ordered = list(rows.values())
    implicit = len(ordered) > 1 and not two_columns and not any(numeric(t) for _, t in ordered[0]) and any(numeric(t) for found in ordered[1:] for _, t in found)
    out = []
    for at, found in enumerate(ordered):
        for column, (kind, text) in enumerate(found):
            header = kind == "th" or (two_columns and column == 0) or (implicit and at == 0)
            out.append({"text": text, "role": "header" if header else "value"})
    return out


@F.pandas_udf(T.StringType())
def html_visible_text(html: pd.Series) -> pd.Series:
    return html.map(visible_text, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def html_segments(html: pd.Series) -> pd.Series:
    return html.map(visible_segments, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("role", T.StringType())])))
def html_cell_roles(html: pd.Series) -> pd.Series:
    return html.map(cell_roles, na_action="ignore")


# The digits and units of Chinese ordinals.
ORDINAL_DIGITS = {"零": 0, "〇": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
ORDINAL_UNITS = {"十": 10, "百": 100, "千": 1000}
ORDINAL_FORM = re.compile(f"[{''.join(ORDINAL_DIGITS)}{''.join(ORDINAL_UNITS)}万]+")
ORDINAL_STEP = re.compile(f"([{''.join(ORDINAL_DIGITS)}]*)([{''.join(ORDINAL_UNITS)}]?)")


def ordinal_value(text: str | None) -> int | None:
    """A Chinese or Arabic ordinal as a number above 0; null for anything else.

    Of digits in a row the last counts; a unit without a digit, or with a zero, counts once; what stands before 万 counts ten thousand times.
    """
    if not text:
        return None
    if text.isdecimal():
        return int(text) or None
    if not ORDINAL_FORM.fullmatch(text):
        return None
    value = 0
    for k, section in enumerate(reversed(text.split("万"))):
        for digits, unit in ORDINAL_STEP.findall(section):
            digit = ORDINAL_DIGITS[digits[-1]] if digits else 0
            value += (10_000 if k else 1) * ((digit or 1) * ORDINAL_UNITS[unit] if unit else digit)
    return value or None


@F.pandas_udf(T.IntegerType())
def chinese_ordinal(text: pd.Series) -> pd.Series:
    return text.map(ordinal_value, na_action="ignore").astype("Int32")
