"""Schema enforcement, validity rules and row-count gates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

REASON = "_reject_reason"


@dataclass(frozen=True)
class Range:
    """Inclusive bounds of a measure; None is open. A null measure is valid."""

    column: str
    low: float | None = None
    high: float | None = None

    def broken(self) -> Column:
        value, out = F.col(self.column), F.lit(False)
        if self.low is not None:
            out = out | (value < self.low)
        if self.high is not None:
            out = out | (value > self.high)
        return F.coalesce(out, F.lit(False))


def first_reason(*checks: tuple[Column, str]) -> Column:
    """The reason of the first check that holds, in order; null if none does."""
    return F.coalesce(*[F.when(broken, F.lit(reason)) for broken, reason in checks])


def tag_rejects(
    df: DataFrame, *, not_null: Sequence[str] = (), ranges: Iterable[Range] = (), domains: dict[str, tuple[Sequence, str]] | None = None
) -> DataFrame:
    """Adds ``_reject_reason``. In order: null keys (``null_<column>``), values outside a domain (its reason), measures out
    of range (``<column>_out_of_range``). Rules on columns that are absent are skipped."""
    checks = [(F.col(c).isNull(), f"null_{c}") for c in not_null]
    for column, (values, reason) in (domains or {}).items():
        checks.append((F.col(column).isNull() | ~F.col(column).isin(*values), reason))
    checks += [(r.broken(), f"{r.column}_out_of_range") for r in ranges if r.column in df.columns]
    return df.withColumn(REASON, first_reason(*checks) if checks else F.lit(None).cast("string"))


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, without the reason, and rejected rows, with it."""
    return tagged.where(F.col(REASON).isNull()).drop(REASON), tagged.where(F.col(REASON).isNotNull())


def enforce_schema(df: DataFrame, schema: StructType, mode: str = "strict") -> DataFrame:
    """The schema's columns in its order and types.

    ``strict``: a missing column is an error, else an unexpected one is; ``report``: one error that lists both, sorted;
    ``lenient``: extra columns are dropped, missing ones are an error.
    """
    wanted = [f.name for f in schema.fields]
    lacking, extra = [c for c in wanted if c not in df.columns], [c for c in df.columns if c not in wanted]
    if mode == "report" and (lacking or extra):
        raise ValueError(f"columns don't match the schema: missing={sorted(lacking)} unexpected={sorted(extra)}")
    if lacking:
        raise ValueError(f"missing columns: {lacking}")
    if extra and mode == "strict":
        raise ValueError(f"unexpected columns: {extra}")
    casts = {f.name: df[f.name].cast(f.dataType) for f in schema.fields}
    return df.withColumns(casts).select(*casts)


class TooFewRows(ValueError):
    """A gate's floor isn't reached."""


def require(rows: int, floor: int, what: str) -> int:
    if rows < floor:
        raise TooFewRows(f"{what}: {rows} rows, at least {floor} are needed")
    return rows


def require_window(valid: DataFrame, days: int, share: float = 0.9) -> int:
    """Action: at least ``share`` of one row a day, rounded down."""
    return require(valid.count(), int(days * share), f"window of {days} days")


def require_collections(valid: DataFrame, collection: str, per_collection: int = 12) -> int:
    """Action: at least so many rows for each distinct collection date, of which there must be one."""
    found = valid.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(collection).alias("c")).first()
    require(found["c"], 1, "collections")
    return require(found["n"], per_collection * found["c"], f"{found['c']} collections")


def threshold(df: DataFrame, measure: str, least: float, name: str = "threshold") -> DataFrame:
    """Rows whose measure reaches the threshold, which may not be negative."""
    if least < 0:
        raise ValueError(f"{name} must not be negative: {least}")
    return df.where(F.col(measure) >= least)
