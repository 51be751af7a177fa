"""Fold supplementary benefits into their primary benefit, keep the orphans.

Rows of the open-claims frame are classified on the benefit name:

=========  ===========================================  =================
class      name test                                     adds (cover, paid)
=========  ===========================================  =================
primary    no 'Super Contribution', not 'Additional...'
SC         starts 'Super Contribution'                   benefit_sc, total_paid_sc
SCAdd      contains 'Additional Super Contribution'      benefit_sc_add, total_paid_sc_add
Add        'Additional ' not followed by 'Super Contr.'  benefit_add, total_paid_add
=========  ===========================================  =================

:func:`fold` left-joins each supplement class onto the primary rows on the
merge key; all matches are kept, so several supplements of one class fan a
primary row out (one row per combination).

:func:`orphans` builds three branches with a supplement on the left and the
*complement* of its class on the right (so the added columns hold the other
row's cover and paid total), stacks them, and keeps only claims without any
primary row (tested first, on the left rows; then one tagged join does the
three branches, with lookups reduced to the candidates' keys).  As in the original report an orphan 'Additional Super
Contribution' row enters through two branches, and in the third it also
matches itself.  A row that mentions 'Super Contribution' without matching
the SC or SCAdd tests (and does not start with 'Additional') appears in no
branch.

All joins use one key, so the join outputs share one hash partitioning and chained
joins do not re-shuffle the wide left side.  A merge key that holds a large share of
the left rows (:func:`heavy_keys`) is dealt over several parts by a hash of the row,
and the few lookup rows of the key are copied to each part: no task gets the whole
key, with or without the help of adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

SUPPLEMENT_COLUMNS = ("benefit_sc", "total_paid_sc", "benefit_sc_add", "total_paid_sc_add",
                      "benefit_add", "total_paid_add")


# A key is heavy when its left rows are more than 1/SHARE of all rows (so at most SHARE
# keys are), and more than LEAST_HEAVY.
SHARE = 256
LEAST_HEAVY = 10_000
PART = "_part"


def heavy_keys(clean: DataFrame, key: str = "sc_key", name: str = "benefit_name", share: int = SHARE,
               least: int = LEAST_HEAVY) -> tuple[dict[str, int], dict[str, int]]:
    """The heavy keys of the primary rows and of the others, and over how many parts to deal each.

    One aggregate that combines map-side; at most ``share`` rows of either kind reach the
    driver.  ``clean`` is read twice and should be staged.
    """
    limit = max(clean.count() // share, least)
    is_primary = F.coalesce(text.is_primary_benefit(F.col(name)), F.lit(False))
    sizes = clean.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count_if(is_primary).alias("_primary"), F.count_if(~is_primary).alias("_other"))
    primary, other = {}, {}
    for row in sizes.filter((F.col("_primary") > limit) | (F.col("_other") > limit)).toLocalIterator():
        for found, n in ((primary, row["_primary"]), (other, row["_other"])):
            if n > limit:
                found[row[key]] = -(-n // limit)
    return primary, other


def _parts(key: str, heavy: dict[str, int]) -> Column:
    """Over how many parts the rows of a key are dealt: 1 but for the heavy keys."""
    known = F.create_map(*[F.lit(x) for pair in heavy.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.col(key)), F.lit(1))


def _dealt(df: DataFrame, key: str, heavy: dict[str, int]) -> DataFrame:
    """Each row with its part, the same at every attempt: rows are told apart by all their columns."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.withColumn(PART, F.pmod(row, _parts(key, heavy)).cast("int")) if heavy else df


def _copied(lookup: DataFrame, key: str, heavy: dict[str, int]) -> DataFrame:
    """Each lookup row once for every part of its key."""
    if not heavy:
        return lookup
    return lookup.withColumn(PART, F.explode(F.sequence(F.lit(0), _parts(key, heavy) - 1)))


def _lookup(df: DataFrame, keep: Column, key: str, cover: str, paid: str,
            cover_as: str, paid_as: str) -> DataFrame:
    return df.filter(keep).select(key, F.col(cover).alias(cover_as), F.col(paid).alias(paid_as))


def fold(clean: DataFrame, key: str = "sc_key", name: str = "benefit_name",
         cover: str = "coverage_amount", paid: str = "total_paid",
         heavy: dict[str, int] | None = None) -> DataFrame:
    """The primary rows with their supplements; ``heavy`` as :func:`heavy_keys` gives it."""
    n, heavy = F.col(name), heavy or {}
    out = _dealt(clean.filter(text.is_primary_benefit(n)), key, heavy)
    on = [key, PART] if heavy else [key]
    for keep, cover_as, paid_as in (
        (text.is_super_contribution(n), "benefit_sc", "total_paid_sc"),
        (text.is_additional_super_contribution(n), "benefit_sc_add", "total_paid_sc_add"),
        (text.is_additional_benefit(n), "benefit_add", "total_paid_add"),
    ):
        out = out.join(_copied(_lookup(clean, keep, key, cover, paid, cover_as, paid_as), key, heavy), on, "left")
    return out.drop(PART)


def _orphan_classes(n: Column):
    """(left rows, lookup rows, cover as, paid as) of the three orphan branches."""
    return (
        (text.is_super_contribution(n), ~text.is_super_contribution(n),
         "benefit_sc", "total_paid_sc"),
        (text.is_additional_super_contribution(n), ~text.is_additional_super_contribution(n),
         "benefit_sc_add", "total_paid_sc_add"),
        (text.starts_additional(n), ~text.is_additional_benefit(n),
         "benefit_add", "total_paid_add"),
    )


def _branch_tags(conds) -> Column:
    """One tag per branch whose condition holds (1, 2, 3), as rows."""
    return F.explode(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(conds, 1)]))


def orphans(clean: DataFrame, key: str = "sc_key", name: str = "benefit_name",
            claim: str = "claim_name", cover: str = "coverage_amount",
            paid: str = "total_paid", heavy: dict[str, int] | None = None) -> DataFrame:
    """Orphan supplements: branch rows whose claim has no primary row.

    Same rows as stacking the three branches' left joins and then dropping claims
    that have a primary row, computed in an order that scales:

    * the claim test (a null-safe anti join against the distinct claims of
      the primary rows) reads only the left row's claim, so it runs first, on
      the rows of any branch class: only orphan candidates go further;
    * each candidate is tagged with the branches it enters (an 'Additional
      Super Contribution' row enters two), each lookup row with the branches
      it serves (the complement classes), and one left join on
      ``(key, branch)`` does all three branches;
    * the lookup, most of ``clean`` up to three times over, is first semi-joined
      to the candidates' keys, before it is tagged, so only rows that can match
      are multiplied and shuffled to the join.
    """
    n, heavy = F.col(name), heavy or {}
    classes = _orphan_classes(n)
    primary_claims = (clean.filter(text.is_primary_benefit(n))
                      .select(F.col(claim).alias("_primary_claim")).distinct())
    any_branch = classes[0][0] | classes[1][0] | classes[2][0]
    candidates = clean.filter(any_branch)
    candidates = candidates.join(
        primary_claims, candidates[claim].eqNullSafe(primary_claims["_primary_claim"]),
        "left_anti")
    tagged = (candidates.withColumn("_branch", _branch_tags([c[0] for c in classes]))
              .filter(F.col("_branch").isNotNull()))
    tagged = _dealt(tagged, key, heavy)
    near = clean.join(tagged.select(key).distinct(), key, "left_semi")
    lookup = (near.select(key, F.col(cover).alias("_cover"), F.col(paid).alias("_paid"),
                          _branch_tags([c[1] for c in classes]).alias("_branch"))
              .filter(F.col("_branch").isNotNull()))
    on = [key, "_branch", PART] if heavy else [key, "_branch"]
    joined = tagged.join(_copied(lookup, key, heavy), on, "left")
    added = []
    for i, (_, _, cover_as, paid_as) in enumerate(classes, 1):
        mine = F.col("_branch") == i
        added += [F.when(mine, F.col("_cover")).alias(cover_as),
                  F.when(mine, F.col("_paid")).alias(paid_as)]
    # column order of the stacked branches: the join key first
    return joined.select(key, *[F.col(f"`{c}`") for c in clean.columns if c != key], *added)


def fold_with_orphans(clean: DataFrame, key: str = "sc_key", name: str = "benefit_name",
                      claim: str = "claim_name", cover: str = "coverage_amount",
                      paid: str = "total_paid") -> DataFrame:
    """Both parts of the report.  The heavy keys are found first: ``clean`` should be staged."""
    primary, other = heavy_keys(clean, key, name)
    folded = fold(clean, key, name, cover, paid, primary)
    return folded.unionByName(orphans(clean, key, name, claim, cover, paid, other))
