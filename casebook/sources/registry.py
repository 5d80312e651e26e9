"""Sources by name: what each plans, fetches and parses. A new source is a row here and a module of plans.

`plan` gives units (key, payload as JSON) whose discovery needs no snapshot; `units` those that the snapshots of a first
round make known. `parse` takes snapshots to documents, `failures` to those that give none, with the reason.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.plans import debates, decisions, judgments, statutes
from casebook.sources import policy
from casebook.sources.fetch import SOURCES

UNIT = "key string, payload string"


@dataclass(frozen=True)
class Source:
    name: str
    corpus: str
    authority: str
    version: str
    revision: int
    plan: Callable[..., DataFrame]
    units: Callable[..., DataFrame] | None
    pages: Callable[[DataFrame], DataFrame] | None  # with a column `error`
    documents: Callable[[DataFrame], DataFrame]
    implemented: bool = True

    @property
    def fetch(self):
        return SOURCES[self.name]

    def parse(self, snapshots: DataFrame) -> DataFrame:
        return self.documents(self.pages(snapshots) if self.pages else snapshots)

    def failures(self, snapshots: DataFrame) -> DataFrame:
        """sha256, error of the snapshots that can't be parsed."""
        if self.pages is None:
            return snapshots.select("sha256", F.lit("").alias("error")).where("false")
        return self.pages(snapshots).where("error is not null").select("sha256", "error")


def _units(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, UNIT)


def _debates(spark, since=None, until=None, **_):
    return debates.planned(since or "2020-01-01", until or str(date.today()), spark)


def _statutes(spark, since=None, until=None, include_sl=False, include_repealed=False, **_):
    if since or until:
        raise ValueError("statutes aren't discovered by dates; ask for versions")
    wanted = [("Act", "Current"), *([("Act", "Repealed")] if include_repealed else []), *([("SL", "Current")] if include_sl else [])]
    return _units(spark, [(f"sso:listing:{a}:{b}:{date.today()}", f'{{"kind": "listing", "path": "/Browse/{a}/{b}/All"}}') for a, b in wanted])


def _judgments(spark, since=None, until=None, last: dict[tuple[str, int], int] | None = None, **_):
    """First listing pages; the others once `last` names the last page of a filter and year."""
    first, end = (date.fromisoformat(x) if x else date.today() for x in (since, until))
    if end < first:
        raise ValueError("the window ends before it begins")
    pages = [(f, y, p) for y in range(first.year, end.year + 1) for f in judgments.FILTERS for p in range(1, (last or {}).get((f, y), 1) + 1)]
    return _units(spark, [(f"elitigation:listing:{f}:{y}:{p}", f'{{"kind": "listing", "filter": "{f}", "year": {y}, "page": {p}}}') for f, y, p in pages])


def _decisions(spark, since=None, until=None, **_):
    rows = [(f"pdpc:sitemap:{date.today()}", '{"kind": "sitemap"}')]
    return _units(spark, rows + [(f"pdpc:listing:{c}:{date.today()}", f'{{"kind": "listing", "collection": "{c}"}}') for c in decisions.COLLECTIONS])


REGISTRY = {
    "hansard": Source("hansard", "hansard", "PARL", debates.VERSION, debates.REVISION, _debates, None, None, debates.documents),
    "sso": Source("sso", "act", "AGC", statutes.VERSION, statutes.REVISION, _statutes, lambda snaps, since=None, until=None, versions=False, **_: statutes.units(snaps, versions), statutes.pages, statutes.documents),
    "elitigation": Source("elitigation", "judgment", "SUPCT", judgments.VERSION, judgments.REVISION, _judgments, lambda snaps, since=None, until=None, **_: judgments.units(snaps, since, until), judgments.pages, judgments.documents),
    "pdpc": Source("pdpc", "pdpc", "PDPC", decisions.VERSION, decisions.REVISION, _decisions, lambda snaps, since=None, until=None, **_: decisions.units(snaps, since, until), decisions.pages, decisions.documents),
}


def get(name: str) -> Source:
    if name not in REGISTRY:
        raise KeyError(f"unknown source {name!r}; there are {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name]


def implemented() -> list[str]:
    return [k for k, x in REGISTRY.items() if x.implemented]


def sources(spark: SparkSession) -> DataFrame:
    """Each source with its policy, where there is one."""
    rows = [(x.name, x.corpus, x.authority, x.version, x.revision, "implemented" if x.implemented else "planned") for x in REGISTRY.values()]
    known = spark.createDataFrame(rows, "name string, corpus string, authority string, adapter_version string, parser_rev int, status string")
    return known.join(F.broadcast(policy.policies(spark)), "name", "left").orderBy("name")  # one row a source
