"""Relationship traversal: dotted parent paths flattened with left joins.

An extract names fields by their path from the fact object, e.g.
``benefit_claimed.claim.policy.scheme.organisation.name`` from a payment
contribution.  :func:`relate` resolves each needed parent *bottom-up*: a
parent is first joined to its own parents (small dimension joins), and the
fact is joined once per direct parent.  The large fact side is therefore
shuffled once per direct relationship, not once per hop, and Catalyst prunes
every parent column the extract does not read.  A missing parent (null or
dangling foreign key) gives nulls, as a relationship query does.  Join
strategy is left to the planner: parents below the broadcast threshold are
broadcast after Spark's own size check, AQE re-plans at runtime, and larger
parents shuffle.  Parents are joined in the declared order of the relationships.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# child object -> relationship name -> (foreign key column, parent object)
RELATIONSHIPS: dict[str, dict[str, tuple[str, str]]] = {
    "payment_contribution": {
        # first, so that facts stored by payment id (sources.store) meet it where they lie
        "payment": ("payment_id", "payment"),
        "benefit_claimed": ("benefit_claimed_id", "benefit_claimed"),
    },
    "benefit_claimed": {
        "claim": ("claim_id", "claim"),
        "benefit": ("benefit_id", "benefit"),
        "modified_by": ("modified_by_id", "user"),
    },
    "claim": {
        "policy": ("policy_id", "policy"),
        "claimant": ("claimant_id", "claimant"),
        "owner": ("owner_id", "user"),
    },
    "policy": {"scheme": ("scheme_id", "scheme")},
    "scheme": {"organisation": ("organisation_id", "organisation")},
    "diagnosis": {"journal": ("journal_id", "journal")},
    "journal": {"claim": ("claim_id", "claim")},
}

_OWN = "."  # key of a node's own field names in the path tree
SEP = "__"


def column_for(path: str) -> str:
    """Flat column name of a dotted path."""
    return path.replace(".", SEP)


def _path_tree(paths) -> dict:
    tree: dict = {}
    for path in paths:
        *hops, field = path.split(".")
        node = tree
        for hop in hops:
            node = node.setdefault(hop, {})
        node.setdefault(_OWN, set()).add(field)
    return tree


def quoted(name: str) -> str:
    """Back-quoted column name for SQL expression strings."""
    return "`" + name.replace("`", "``") + "`"


def rename_select(df: DataFrame, mapping) -> DataFrame:
    """``select(col(src).alias(out) ...)`` in one call (pairs of out, src)."""
    return df.selectExpr(*[f"{quoted(src)} AS {quoted(out)}" for out, src in mapping])


def _attach_parents(tables: Mapping[str, DataFrame], entity: str, df: DataFrame,
                    columns: list[str], tree: dict) -> tuple[DataFrame, list[str]]:
    relationships = RELATIONSHIPS.get(entity, {})
    for rel in tree.keys() - relationships.keys() - {_OWN}:
        known = ", ".join(sorted(relationships)) or "none"
        raise ValueError(f"{entity} has no relationship {rel!r} (known: {known})")
    for rel, (fk, parent_entity) in relationships.items():
        if rel not in tree:
            continue
        sub = tree[rel]
        grand = RELATIONSHIPS.get(parent_entity, {})
        needed = ["id", *sorted((set(sub.get(_OWN, ()))
                                 | {grand[r][0] for r in sub if r != _OWN}) - {"id"})]
        parent, parent_cols = _attach_parents(
            tables, parent_entity, tables[parent_entity].select(*needed), needed, sub)
        prefixed = [rel + SEP + c for c in parent_cols]
        df = df.join(parent.toDF(*prefixed), F.col(fk) == F.col(rel + SEP + "id"), "left")
        columns = columns + prefixed
    return df, columns


def relate(tables: Mapping[str, DataFrame], entity: str, fields: Mapping[str, str],
           fact: DataFrame | None = None) -> DataFrame:
    """Flatten ``fields`` (output name -> dotted path from ``entity``).

    ``tables`` maps object names to DataFrames with an ``id`` column and the
    foreign keys of :data:`RELATIONSHIPS`; ``fact`` overrides ``tables[entity]``.
    """
    fact = tables[entity] if fact is None else fact
    flat, _ = _attach_parents(tables, entity, fact, [], _path_tree(fields.values()))
    return rename_select(flat, [(a, column_for(p)) for a, p in fields.items()])
