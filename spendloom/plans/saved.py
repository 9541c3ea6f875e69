"""Saved queries: SQL text with a stated question, period, source, metrics and caveats."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.plans.warehouse import MODELS

# The header fields every saved query must state.
REQUIRED = ("question", "period", "source", "metrics", "caveats")
FOLDER = Path(__file__).parent / "queries"


@dataclass(frozen=True)
class Answer:
    header: dict[str, str]
    rows: DataFrame
    provenance: DataFrame


def load_saved_query(ref: str | Path) -> tuple[dict[str, str], str]:
    """A file path, or the name of a query in the package folder. The comment lines on top are
    its header, one ``field: value`` each; it is refused unless every required field is there."""
    path = Path(ref)
    text = (path if path.exists() else FOLDER / f"{ref}.sql").read_text()
    header: dict[str, str] = {}
    for line in filter(None, map(str.strip, text.splitlines())):
        if not line.startswith("--"):
            break
        field, _, value = line.lstrip("- ").partition(":")
        if value.strip():
            header.setdefault(field.strip(), value.strip())
    missing = sorted(set(REQUIRED) - set(header), key=REQUIRED.index)
    if missing:
        raise ValueError(f"saved query {path.name} does not state: {', '.join(missing)}")
    return header, text


def provenance(freshness: DataFrame) -> DataFrame:
    """How current the answer is, per client, and whether any source is synthetic."""
    as_of = lambda s: F.max(F.when(F.col("source") == s, F.col("data_as_of")))
    return freshness.groupBy("client").agg(
        as_of("ad_platforms").alias("platform_as_of"),
        as_of("crm").alias("crm_as_of"),
        F.bool_or("is_synthetic").alias("synthetic"),
    )


# A quoted text, a quoted name, a comment, or the name of a model with its database.
_TOKEN = re.compile(r"'(?:[^']|'')*'|`[^`]*`|\"[^\"]*\"|--[^\n]*|/\*.*?\*/|\b(?:core|marts)\.(\w+)", re.S)


# What a saved query may read besides its own WITH parts, and functions that run other code or leave the tables.
TABLES = {f"{database}.{name}" for name, database in MODELS.items()}
_REFUSED = {"reflect", "java_method", "try_reflect"}
_ROWS_FROM = {"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack"}
_QUERY_PARTS = ("catalyst.plans.logical.", "catalyst.expressions.", "catalyst.analysis.")


def _nodes(tree: object) -> Iterator[dict]:
    """All nodes of a plan, those inside expressions and WITH parts too."""
    if isinstance(tree, list):
        for part in tree:
            yield from _nodes(part)
    elif isinstance(tree, dict):
        yield tree
        for part in tree.values():
            yield from _nodes(part)


def _names(node: dict, field: str) -> str:
    return ".".join(x.strip() for x in str(node.get(field, "")).strip("[]").split(","))


def check_read_only(spark: SparkSession, query: str, views: Iterable[str] = ()) -> None:
    """Refuse a query by its plan: it may hold nothing but parts of queries, read the saved models (or these
    views) and its own WITH parts, and call no function that runs other code."""
    plan = json.loads(spark._jsparkSession.sessionState().sqlParser().parsePlan(query).toJSON())
    nodes = [n for n in _nodes(plan) if "class" in n]
    own = {part["_1"].lower() for n in nodes if n["class"].endswith(".UnresolvedWith") for part in n.get("cteRelations", [])}
    allowed = TABLES | own | {v.lower() for v in views}
    for n in nodes:
        kind = n["class"].removeprefix("org.apache.spark.sql.")
        plain = kind.startswith(_QUERY_PARTS) and not kind.endswith(("Command", "Statement"))
        if not plain or "Script" in kind or "Reflect" in kind:
            raise ValueError(f"a saved query only reads: {kind.rsplit('.', 1)[-1]} is refused")
        if kind.endswith(".UnresolvedRelation") and _names(n, "multipartIdentifier").lower() not in allowed:
            raise ValueError(f"a saved query reads saved models only, not {_names(n, 'multipartIdentifier')}")
        if kind.endswith(".UnresolvedFunction") and _names(n, "nameParts").lower().rsplit(".", 1)[-1] in _REFUSED:
            raise ValueError(f"a saved query may not call {_names(n, 'nameParts')}")
        if kind.endswith(".UnresolvedTableValuedFunction") and _names(n, "name").lower() not in _ROWS_FROM:
            raise ValueError(f"a saved query may not read from {_names(n, 'name')}")


def run_saved_query(
    spark: SparkSession, ref: str | Path, models: dict[str, DataFrame] | None = None
) -> Answer:
    """Run the text read-only. It stands inside a subquery, where Spark's grammar allows
    nothing but a query, so a statement that writes does not parse; `check_read_only` looks at the rest.

    Without ``models`` the text runs as it is over the saved tables. With ``models``, of which
    one must be ``mart_freshness``, it runs over those frames: under temporary names of their own,
    which are gone afterwards, so no view of the caller is touched.
    """
    header, text = load_saved_query(ref)
    views: dict[str, str] = {}
    if models is None:
        freshness = spark.table("marts.mart_freshness")
    else:
        freshness = models["mart_freshness"]
        views = {name: f"saved_{uuid4().hex}" for name in models}
        text = _TOKEN.sub(lambda m: views.get(m[1], m[0]) if m[1] else m[0], text)
    try:
        for name, view in views.items():
            models[name].createTempView(view)
        query = f"SELECT * FROM (\n{text.rstrip().rstrip(';')}\n)"
        check_read_only(spark, query, views.values())
        rows = spark.sql(query)
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)
    return Answer(header, rows, provenance(freshness))
