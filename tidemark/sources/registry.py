"""Dataset contracts as data: request checks, mappings that become plans, duplicate policies, SQL templates."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_group


class ContractError(ValueError):
    """A contract, request or template that the registry does not allow."""


@dataclass(frozen=True)
class Parameter:
    name: str
    required: bool = False
    default: object = None
    allowed: Sequence[object] | None = None


@dataclass(frozen=True)
class Mapped:
    source: str
    multiply: float | None = None
    transform: str | None = None

    def column(self) -> Column:
        value = F.col(self.source)
        if self.transform == "yyyymmdd_to_date":
            value = F.try_to_date(value.cast("string"), "yyyyMMdd")
        elif self.transform is not None:
            raise ContractError(f"unknown transform {self.transform}")
        return value * self.multiply if self.multiply is not None else value


@dataclass(frozen=True)
class Contract:
    key: str
    columns: Mapping[str, str]
    primary_key: Sequence[str]
    parameters: Sequence[Parameter] = ()
    mapping: Mapping[str, Mapped] = field(default_factory=dict)
    checks: Mapping[str, str] = field(default_factory=dict)
    scope: Mapping[str, Sequence[object]] = field(default_factory=dict)
    duplicates: str = "fail"
    latest_by: Sequence[str] = ()

    def __post_init__(self):
        if unmapped := set(self.mapping) - set(self.columns):
            raise ContractError(f"mapped columns that are not declared: {sorted(unmapped)}")
        if missing := set(self.primary_key) - set(self.columns):
            raise ContractError(f"key columns that are not declared: {sorted(missing)}")
        if self.duplicates not in ("fail", "keep_latest"):
            raise ContractError(f"unknown duplicate policy {self.duplicates}")


def load_contracts(folder: str) -> dict[str, dict]:
    """JSON contract files by key; a file's name must be its key. YAML is read too where a YAML library is installed."""
    found = {}
    for path in sorted(Path(folder).iterdir()):
        if path.suffix == ".json":
            content = json.loads(path.read_text())
        elif path.suffix in (".yaml", ".yml"):
            try:
                import yaml
            except ImportError as error:
                raise ContractError(f"{path.name} needs a YAML library") from error
            content = yaml.safe_load(path.read_text())
        else:
            continue
        if content.get("key") != path.stem:
            raise ContractError(f"{path.name} holds the key {content.get('key')}")
        found[path.stem] = content
    return found


def checked_request(parameters: Sequence[Parameter], request: Mapping[str, object]) -> dict[str, object]:
    """The request with defaults; unknown, missing and not allowed values are errors."""
    known = {p.name: p for p in parameters}
    if unknown := set(request) - set(known):
        raise ContractError(f"unknown parameters: {sorted(unknown)}")
    out = {}
    for p in parameters:
        value = request.get(p.name, p.default)
        if value is None and p.required:
            raise ContractError(f"missing parameter: {p.name}")
        if value is not None and p.allowed is not None and value not in p.allowed:
            raise ContractError(f"{p.name} must be one of {list(p.allowed)}")
        out[p.name] = value
    return out


def choose_variant(variants: Sequence[tuple[Mapping[str, object], str]], request: Mapping[str, object]) -> str:
    """The first variant whose single condition, if it has one, the request meets."""
    for when, name in variants:
        if len(when) > 1:
            raise ContractError("a variant has at most one condition")
        if all(request.get(k) == v for k, v in when.items()):
            return name
    raise ContractError("no variant fits the request")


def apply_contract(rows: DataFrame, contract: Contract) -> DataFrame:
    """Scope filters, mapped and typed columns, and the duplicate policy."""
    for column, values in contract.scope.items():
        rows = rows.where(F.col(column).isin(*values))
    mapping = {name: contract.mapping.get(name, Mapped(name)) for name in contract.columns}
    typed = rows.select(*[mapping[name].column().cast(kind).alias(name) for name, kind in contract.columns.items()])
    if contract.duplicates == "keep_latest":
        others = [c for c in contract.columns if c not in contract.primary_key and c not in contract.latest_by]
        return latest_per_group(typed, contract.primary_key, [*[F.desc_nulls_last(c) for c in contract.latest_by], *[F.asc_nulls_last(c) for c in others]])
    return typed


def duplicate_keys(rows: DataFrame, contract: Contract) -> DataFrame:
    """Keys that occur more than once: what the policy "fail" reports."""
    return rows.groupBy(*contract.primary_key).agg(F.count("*").alias("n")).where("n > 1")


def active_table(candidates: Mapping[str, DataFrame], date_column: str, pin: str | None = None) -> str:
    """The pinned candidate, else the one of the greatest date, else the first; one job over all of them."""
    if pin is not None:
        if pin not in candidates:
            raise ContractError(f"{pin} is not a candidate")
        return pin
    newest = freshest(candidates, date_column).where("newest is not null").orderBy(F.desc("newest"), "position").first()
    return newest["name"] if newest else next(iter(candidates))


def freshest(candidates: Mapping[str, DataFrame], date_column: str) -> DataFrame:
    """Greatest date per candidate: name, position, newest."""
    parts = [frame.agg(F.max(date_column).alias("newest")).select(F.lit(name).alias("name"), F.lit(k).alias("position"), "newest") for k, (name, frame) in enumerate(candidates.items())]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


#: Statements that a template may not contain: fixed by the contract.
DENIED = re.compile(r"\b(insert|update|delete|merge|drop|alter|create|grant|revoke|truncate|call|copy|set)\b|--|/\*", re.I)


def checked_template(sql: str, binds: Sequence[str], required_predicate: str, row_cap: int) -> str:
    """A single SELECT without a star, whose binds are exactly the declared ones, with the required predicate and a row cap."""
    text = sql.strip().rstrip(";").strip()
    if ";" in text or not re.match(r"(?is)^(select|with)\b", text):
        raise ContractError("a template is one SELECT statement")
    if DENIED.search(text):
        raise ContractError("the template has a word that is not allowed")
    if re.search(r"(?i)\bselect\s+(distinct\s+)?\*|\.\s*\*|,\s*\*", text):
        raise ContractError("columns must be named")
    if re.search(r"\{\{|\}\}|\$\{|%\(", text):
        raise ContractError("values come in as binds only")
    used = set(re.findall(r":([a-zA-Z_]\w*)", text))
    if used != set(binds):
        raise ContractError(f"declared and used binds differ: {sorted(used ^ set(binds))}")
    if required_predicate.lower() not in re.sub(r"\s+", " ", text.lower()):
        raise ContractError(f"the predicate {required_predicate} is required")
    return f"SELECT * FROM ({text}) AS template LIMIT {int(row_cap)}"


def run_template(spark: SparkSession, sql: str, binds: Mapping[str, object], required_predicate: str, row_cap: int = 100_000) -> DataFrame:
    return spark.sql(checked_template(sql, list(binds), required_predicate, row_cap), args=dict(binds))
