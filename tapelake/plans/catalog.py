"""The closed query catalogue: modes, their parameters, and saved queries with a history.

A mode is run over canonical rows (see `views.rows`) and the tables it names; parameters are
checked before anything is planned. An unknown selection is an empty result; a malformed one is
an error.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import calendar as cal
from ..operators import islands as isl
from ..operators.package import atomic_json, load_json
from ..schema import OVERLAY_SERIES

FILTERS = {"series": "series", "segment": "sgmt", "source": "src", "instrument_type": "fininstrmtp", "symbol": "symbol"}


class QueryError(ValueError):
    """A parameter or a selection that the mode does not allow."""


def iso(text) -> date:
    if not isinstance(text, str) or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise QueryError(f"not an ISO date: {text!r}")
    try:
        return date.fromisoformat(text)
    except ValueError as e:
        raise QueryError(str(e)) from None


@dataclass
class Tables:
    """The frames a catalogue runs on; `rows` as from `views.rows`."""

    rows: DataFrame
    members: DataFrame
    metrics: DataFrame
    evidence: DataFrame | None = None
    holidays: DataFrame | None = None


@dataclass(frozen=True)
class Mode:
    run: Callable
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    together: tuple[tuple[str, ...], ...] = field(default=())


def _and(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def dataset(t: Tables, family=None, year=None) -> DataFrame:
    r = t.rows.where(_and([F.col(c) == v for c, v in (("format_family", family), ("year", year)) if v is not None]))
    return r.groupingSets([["format_family", "year"], []], "format_family", "year").agg(F.countDistinct("file_name").alias("files"), F.count("*").alias("row_count"),
        F.countDistinct(F.struct("symbol", "series")).alias("instruments"))


def date_range(t: Tables, date_from, date_to) -> DataFrame:
    a, b = iso(date_from), iso(date_to)
    return t.rows.where(F.col("trade_date").between(a, b)) if a <= b else t.rows.limit(0)


def resolve(t: Tables, symbol: str, series: str) -> DataFrame:
    """The identity a ticker was seen under, at most one row; raises if the ticker is ambiguous. Never narrowed by year."""
    census = isl.ticker_census(t.rows.where(F.col("series") == series))
    mine = census.where(F.col("ticker") == symbol)
    if isl.shared_tickers(mine).limit(1).collect():
        raise QueryError(f"{symbol}/{series} was used by more than one identity")
    ids = mine.where("identity is not null").select("identity").distinct()
    family = census.join(ids, "identity", "left_semi")
    clash = isl.overlapping_tickers(family).where((F.col("ticker_1") == symbol) | (F.col("ticker_2") == symbol))
    if clash.limit(1).collect():
        raise QueryError(f"{symbol}/{series} overlaps another ticker of its identity")
    return ids


def instrument(t: Tables, symbol, series, year=None) -> DataFrame:
    ids = resolve(t, symbol, series).select(F.col("identity").alias("_i"))
    r = t.rows.where(F.col("series") == series).join(F.broadcast(ids), F.col("identity") == F.col("_i"), "left")  # one row at most
    r = r.where((F.col("ticker") == symbol) | F.col("_i").isNotNull() | ((F.col("ticker").isNull()) & (F.col("symbol") == symbol))).drop("_i")
    return r if year is None else r.where(F.col("year") == int(year))


def filtered(t: Tables, filters) -> DataFrame:
    if not isinstance(filters, dict) or not filters:
        raise QueryError("filters must name at least one field")
    for k, v in filters.items():
        if k not in FILTERS or not isinstance(v, str):
            raise QueryError(f"not a filter: {k}={v!r}")
    return t.rows.where(_and([F.col(FILTERS[k]) == v for k, v in filters.items()]))


def association(t: Tables, security_id=None, symbol=None, series=None) -> DataFrame:
    if security_id is None and (symbol is None or series is None):
        raise QueryError("security_id, or symbol and series, are needed")
    keyed = t.rows.where((F.col("isin_n") != "") & F.coalesce(~F.col("series").isin(*OVERLAY_SERIES), F.lit(True)))
    if security_id is not None:
        keyed = keyed.where(F.col("isin_n") == security_id.strip().upper())
    if symbol is not None:
        ids = resolve(t, symbol, series)
        keyed = keyed.join(F.broadcast(ids.select(F.col("identity").alias("isin_n"))), "isin_n", "left_semi")  # one row at most
    found = isl.associations_with_tickers(isl.associations(keyed), isl.ticker_census(t.rows))
    return found if series is None else found.where(F.col("series") == series)


def calendar_days(t: Tables, date_from=None, date_to=None) -> DataFrame:
    files = t.members.select(F.col("date_from_filename").alias("trade_date"), F.col("detected_format").alias("family"), "file_name")
    days = cal.calendar(files, t.holidays)
    return days if date_from is None else days.where(F.col("trade_date").between(iso(date_from), iso(date_to)))


def record_detail(t: Tables, source_file, source_line_number) -> DataFrame:
    if not isinstance(source_line_number, int) or source_line_number < 1:
        raise QueryError("source_line_number starts at 1")
    row = t.rows.where((F.col("file_name") == source_file) & (F.col("source_line_number") == source_line_number))
    if not row.limit(1).collect():
        raise QueryError(f"no line {source_line_number} in {source_file}")
    archive = t.members.select("file_name", "relative_path", "sha256")
    checks = t.metrics.groupBy("member_id").agg(F.collect_list(F.struct("metric_id", "row_count", "blank_isin_rows", "invalid_isin_rows")).alias("reconciliation"))  # one file's records
    return row.join(archive, "file_name").join(checks, "member_id", "left")


def data_quality(t: Tables) -> DataFrame:
    return t.rows.groupBy("validity").agg(F.count("*").alias("row_count"), F.countDistinct("file_name").alias("files"))


def archive_inventory(t: Tables) -> DataFrame:
    x = t.metrics.groupBy("member_id").agg(F.count("*").alias("metrics"))
    return t.members.select("member_id", "root", "relative_path", "sha256", "row_count").join(x, "member_id", "left").orderBy("root", "relative_path")


# States of a piece of evidence.
STATES = ("absent", "unreadable", "integrity-mismatch", "not-identity-bound", "not-associated", "associated")


def qualification(t: Tables, bindings) -> DataFrame:
    """Evidence documents with `state` and `basis` against the package: every binding that a document has must agree.

    Optional columns of the evidence come first: present (false: absent), readable (false:
    unreadable), said_sha256 and actual_sha256 (unequal: integrity-mismatch). A document that
    carries none of the bindings is not identity-bound. `basis` names the bindings that hold or fail.
    """
    if t.evidence is None:
        raise QueryError("no evidence table")
    if not isinstance(bindings, dict) or not bindings:
        raise QueryError("bindings must name at least one field")
    has = lambda c: F.col(c) if c in t.evidence.columns else F.lit(None)
    present = [F.col(k).isNotNull() for k in bindings]
    differs = {k: F.coalesce(F.col(k) != F.lit(v), F.lit(False)) for k, v in bindings.items()}
    off = reduce(lambda a, b: a | b, differs.values())
    state = (
        F.when(~F.coalesce(has("present").cast("boolean"), F.lit(True)), STATES[0]).when(~F.coalesce(has("readable").cast("boolean"), F.lit(True)), STATES[1])
        .when(F.coalesce(has("said_sha256") != has("actual_sha256"), F.lit(False)), STATES[2]).when(~reduce(lambda a, b: a | b, present), STATES[3])
        .when(off, STATES[4]).otherwise(STATES[5])
    )
    named = lambda which: F.array_join(F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in which.items()]))), ", ")
    holds = {k: F.coalesce(F.col(k) == F.lit(v), F.lit(False)) for k, v in bindings.items()}
    basis = F.when(F.col("state") == STATES[4], F.concat(F.lit("mismatch: "), named(differs))).when(F.col("state") == STATES[5], F.concat(F.lit("holds: "), named(holds))).otherwise(F.col("state"))
    return t.evidence.withColumn("state", state).withColumn("basis", basis)


MODES = {
    "dataset": Mode(dataset, optional=("family", "year")),
    "date-range": Mode(date_range, ("date_from", "date_to")),
    "instrument": Mode(instrument, ("symbol", "series"), ("year",)),
    "filter": Mode(filtered, ("filters",)),
    "association": Mode(association, optional=("security_id", "symbol", "series"), together=(("symbol", "series"),)),
    "calendar": Mode(calendar_days, optional=("date_from", "date_to"), together=(("date_from", "date_to"),)),
    "record-detail": Mode(record_detail, ("source_file", "source_line_number")),
    "data-quality": Mode(data_quality),
    "archive-inventory": Mode(archive_inventory),
    "qualification": Mode(qualification, ("bindings",)),
}
# Operations that are declared and never offered.
UNSUPPORTED = (
    "eligibility_predicate", "etf_register_join", "master_snapshot_dated_association", "delisting_marker", "corporate_action_colocation", "t0_volume_inclusion_rule",
    "it_series_interpretation", "sf_series_interpretation", "be_rights_vs_t2t_split", "sgb_stk_semantics", "xcont_boundary_continuity_policy", "fininstrm_id_namespace_resolution",
    "calendar_gap_label", "sme_surveillance_stage_classification", "legacy_era_holiday_label", "undocumented_transition_continuity", "production_ingestion", "authoritative_storage_decision",
)


def check(mode: str, params: dict) -> None:
    """Raise unless the mode exists and its parameters are complete."""
    if mode in UNSUPPORTED:
        raise QueryError(f"{mode} is not supported")
    if mode not in MODES:
        raise QueryError(f"no mode {mode}")
    m = MODES[mode]
    if missing := [k for k in m.required if params.get(k) is None]:
        raise QueryError(f"{mode} needs {', '.join(missing)}")
    if extra := sorted(set(params) - {*m.required, *m.optional}):
        raise QueryError(f"{mode} does not take {', '.join(extra)}")
    for group in m.together:
        if 0 < sum(params.get(k) is not None for k in group) < len(group):
            raise QueryError(f"{' and '.join(group)} go together")


def run(tables: Tables, mode: str, **params) -> DataFrame:
    check(mode, params)
    return MODES[mode].run(tables, **params)


def latest_years(tables: Tables, n: int) -> dict:
    """Parameters of a date range over the latest `n` years of the data, not of the clock."""
    last = tables.members.agg(F.max("date_from_filename")).first()[0]
    if last is None:
        raise QueryError("no dated file")
    return {"date_from": f"{last.year - n + 1}-01-01", "date_to": f"{last.year}-12-31"}


class Store:
    """Saved queries and the history of runs in one JSON document; sequence numbers are never used again."""

    def __init__(self, path: str):
        self.path = path

    def _load(self) -> dict:
        if not os.path.exists(self.path):
            return {"saved": {}, "history": [], "next": 1}
        return load_json(self.path)

    def save(self, name: str, mode: str, params: dict) -> None:
        check(mode, params)
        doc = self._load()
        doc["saved"][name] = {"mode": mode, "params": params}
        atomic_json(self.path, doc)

    def names(self) -> list[str]:
        return sorted(self._load()["saved"])

    def delete(self, name: str) -> None:
        doc = self._load()
        if doc["saved"].pop(name, None) is None:
            raise QueryError(f"no saved query {name}")
        atomic_json(self.path, doc)

    def run(self, tables: Tables, name: str) -> DataFrame:
        doc = self._load()
        if name not in doc["saved"]:
            raise QueryError(f"no saved query {name}")
        q = doc["saved"][name]
        out = run(tables, q["mode"], **q["params"])
        doc["history"].append({"seq": doc["next"], "name": name, **q})
        doc["next"] += 1
        atomic_json(self.path, doc)
        return out

    def history(self) -> list[dict]:
        return self._load()["history"]

    def forget(self, seq: int) -> None:
        doc = self._load()
        doc["history"] = [h for h in doc["history"] if h["seq"] != seq]
        atomic_json(self.path, doc)
