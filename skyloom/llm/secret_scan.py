"""Secrets, and how widely each candidate is copied over the corpus.

Every match of a kind is a candidate.  Candidates are hashed and counted by
distinct repositories and owners over the whole corpus: one that many owners
have is a copied example, one of a single owner looks like a live credential.
All steps are column expressions, groupings and joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import text_of, written


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    group: int
    least: int
    base: bool
    also: tuple[str, ...] = ()


# Kinds of the base result, in their order.  The second and third
# state their least length in the pattern; the same matches remain.
KINDS = (
    Kind(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8, True,
    ),
    Kind("access", r"AKIA[A-Z0-9]{12,}", 0, 16, True),
    Kind("hex", r"[0-9a-f]{32,}", 0, 32, True),
    # what the method adds: long tokens of mixed characters, where one owner alone has them
    Kind("mixed", r"[A-Za-z0-9+/_=-]{20,}", 0, 20, False, ("[a-z]", "[A-Z]", "[0-9]")),
)


def _matches(text: Column, kind: Kind, number: int) -> Column:
    """Leftmost matches that do not overlap: (kind, number, index, characters
    before since the last match, characters, value).  Splitting by the pattern
    gives the stretches between the same matches."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)) if kind.group else found
    gaps = F.transform(F.split(text, kind.pattern, -1), F.length)
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("found"), value.alias("value"))
    items = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(number).alias("number"), i.alias("i"), x["gap"].alias("gap"),
            F.length(x["found"]).alias("chars"), x["value"].alias("value"),
        ),
    )
    none = F.array().cast("array<struct<number:int,i:int,gap:int,chars:int,value:string>>")
    return F.when(text.rlike(kind.pattern), items).otherwise(none)


def candidates(
    docs: DataFrame, kinds: tuple[Kind, ...], id_col: str, text_col: str, owner_col: str, repo_col: str
) -> tuple[DataFrame, DataFrame]:
    """(documents: row, doc_id), (candidates: row, owner, repo, kind, start, end, hash)."""
    text = F.col("text")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{owner_col}`").cast("string").alias("owner"),
        F.col(f"`{repo_col}`").cast("string").alias("repo"), text_of(f"`{text_col}`").alias("text"),
    )
    found = written(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repo",
            F.concat(*[_matches(text, kind, i) for i, kind in enumerate(kinds)]).alias("items"),
        ),
        "secrets",
    )
    each = found.where(F.size("items") > 0).select("row", "owner", "repo", F.explode("items").alias("x"))
    each = each.select("row", "owner", "repo", "x.*")
    upto = Window.partitionBy("row", "number").orderBy("i")
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("chars")).over(upto))
    keep = F.lit(False)
    for i, kind in enumerate(kinds):
        good = (F.col("number") == i) & (F.length("value") >= kind.least)
        for part in kind.also:
            good = good & F.col("value").rlike(part)
        keep = keep | good
    name = F.element_at(F.array(*[F.lit(k.name) for k in kinds]), F.col("number") + 1)
    base = F.element_at(F.array(*[F.lit(k.base) for k in kinds]), F.col("number") + 1)
    each = each.where(keep).select(
        "row", "owner", "repo", "number", name.alias("kind"), base.alias("base"),
        (F.col("end") - F.col("chars")).alias("start"), "end", F.sha2("value", 256).alias("hash"),
    )
    return found.select("row", "doc_id"), without_overlaps(each)


def without_overlaps(each: DataFrame) -> DataFrame:
    """Candidates without those of the method that share characters with a base one,
    so that no secret counts twice.  Looks at the candidates of one document."""
    by_start = Window.partitionBy("row").orderBy("start")
    upto = F.max(F.when(F.col("base"), F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rangeBetween(0, Window.unboundedFollowing))
    meets = F.coalesce(upto > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))
    return each.withColumn("meets", meets).where(F.col("base") | ~F.col("meets")).drop("meets")


def ownership(each: DataFrame) -> DataFrame:
    """Per hash: owners and repositories that have it.  Three groupings, each
    reduced before its shuffle, so a hash that is everywhere stays cheap."""
    by_repo = each.groupBy("hash", "owner", "repo").agg(F.count("*").alias("places"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("places").alias("places"))
    return by_owner.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("repos").alias("repos"), F.sum("places").alias("places")
    )


def secret_spans(
    docs: DataFrame,
    kinds: tuple[Kind, ...] = KINDS,
    max_owners: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str = "doc_id",
) -> DataFrame:
    """One row per document: doc_id, and ``spans`` (start, number, kind, end, base,
    owners, repos, live) by start, then kind; positions are code points, end exclusive.

    A candidate is live if at most ``max_owners`` owners have its value.  Base
    kinds are reported in any case; a kind of the method only where it is live and
    shares no character with a base span.
    A null owner or repository counts as one of its own.  Null and empty texts
    have no spans; repeated rows repeat theirs; an empty table gives no rows.
    Other columns are not read.
    """
    rows, each = candidates(docs, kinds, id_col, text_col, owner_col, repo_col)
    each = written(each, "candidates")
    live = F.col("owners") <= max_owners
    # stored, so that both sides of the join are plain shuffles and a hot value can be split
    owned = written(ownership(each), "owners")
    known = each.join(owned, "hash").withColumn("live", live).where(F.col("base") | F.col("live"))
    spans = known.groupBy("row").agg(
        F.sort_array(
            F.collect_list(F.struct("start", "number", "kind", "end", "base", "owners", "repos", "live"))
        ).alias("spans")
    )
    return rows.join(spans, "row", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans")
    )
