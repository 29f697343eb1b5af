"""Record sets against what is stated of them: features of tokens, totals, pinned records, aliases, waves, populations, expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import cut


def morph_counts(tokens: DataFrame, feature: str, upos: str | None = None) -> DataFrame:
    """Counted tokens by modality and value of a morphological feature; those without it are left out. tokens: modality, upos, counted, morph (map)."""
    value = F.try_element_at("morph", F.lit(feature))
    rows = tokens.where("counted").where(F.col("upos") == upos) if upos else tokens.where("counted")
    return rows.where(value.isNotNull()).groupBy("modality", value.alias("value")).agg(F.count("*").alias("tokens"))


def totals_differ(stated: DataFrame, rows: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """key, measure, stated and found of totals that the records do not give. stated: key and the measures; a side that is missing is null."""
    found = rows.groupBy(key).agg(*[F.sum(m).alias(m) for m in measures])
    long = lambda df, name: df.select(key, F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("long").alias(name)) for m in measures])).alias("x")).select(key, "x.*")
    return long(stated, "stated").join(long(found, "found"), [key, "measure"], "full_outer").where(~F.col("stated").eqNullSafe(F.col("found")))


def restorable(selected: DataFrame, pinned: DataFrame) -> DataFrame:
    """Selected records and why the pinned releases cannot give them back, if so: no_release, no_document or other_content.

    selected, pinned: release, document, content. A release is known if it has any document.
    """
    releases = pinned.select("release").distinct().withColumn("known", F.lit(True))
    there = pinned.select("release", "document", F.col("content").alias("there"), F.lit(True).alias("held"))
    problem = F.when(F.col("known").isNull(), "no_release").when(F.col("held").isNull(), "no_document").when(~F.col("there").eqNullSafe(F.col("content")), "other_content")
    return selected.join(releases, "release", "left").join(there, ["release", "document"], "left").select("release", "document", problem.alias("problem"))


def aliases(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Every registered outlet that an old name stands for: all matches, none chosen. rows: country, slug. registry: outlet, country, slugs (array)."""
    asked = rows.select("country", "slug").distinct()  # a name is joined once, however many rows have it
    return registry.select("outlet", "country", F.explode("slugs").alias("slug")).join(asked, ["country", "slug"], "left_semi").select("country", "slug", "outlet").distinct()


def waves_used(baselines: DataFrame, authorization: object, but: object = None) -> DataFrame:
    """Waves that manifests under an authorisation have used, one manifest left out. baselines: authorization, manifest, wave."""
    own = baselines.where(F.col("authorization") == F.lit(authorization))
    return (own.where(~F.col("manifest").eqNullSafe(F.lit(but))) if but is not None else own).select("wave").where("wave is not null").distinct()


def population(rows: DataFrame, digits: int = 2) -> DataFrame:
    """Per outlet: members, first and last time, and a digest of the set of ids that does not depend on their order.

    rows: outlet, id, at. Ids are dealt to buckets by the first digits of their hashes; the digest is over the sorted buckets' digests, so that no row
    holds all ids of an outlet.
    """
    part = rows.groupBy("outlet", F.left(F.sha2(F.col("id").cast("string"), 256), F.lit(digits)).alias("bucket")).agg(
        F.count("*").alias("n"), F.min("at").alias("first"), F.max("at").alias("last"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.col("id").cast("string"))), "\n"), 256).alias("sha"),
    )
    digest = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "sha"))), lambda x: x["sha"]), "\n"), 256)
    return part.groupBy("outlet").agg(F.sum("n").alias("members"), F.min("first").alias("first"), F.max("last").alias("last"), digest.alias("ids_sha256"))


def expanded(edges: DataFrame, roots: DataFrame, depth: int, width: int) -> DataFrame:
    """Documents that a breadth-first reading reaches: url, level and the first document that named it.

    edges: parent, url, rank (reading order). roots: url. Each level reads at most `width` of the new documents, the least ranks
    first, and none twice, so that cycles end. The loop is over levels, of which there are few; each is a join.
    """
    levels = cut(roots.select("url", F.lit(0).alias("level"), F.lit(None).cast(edges.schema["parent"].dataType).alias("parent")).distinct())
    for level in range(1, depth + 1):
        here = levels.where(F.col("level") == level - 1).select(F.col("url").alias("parent"))
        named = edges.join(here, "parent").groupBy("url").agg(F.min(F.struct("rank", "parent")).alias("by"))
        fresh = named.join(levels.select("url"), "url", "left_anti").orderBy("by.rank", "url").limit(width)  # a top-k of each partition
        levels = cut(levels.unionByName(fresh.select("url", F.lit(level).alias("level"), F.col("by.parent").alias("parent"))))
    return levels


def ranked(df: DataFrame, group: str, order: str, tie: str, buckets: int) -> DataFrame:
    """Each row's place in its group: ntile, percent_rank and the mean of the three rows around it."""
    w = Window.partitionBy(group).orderBy(order, tie)
    return df.select(group, tie, F.ntile(buckets).over(w).alias("tile"), F.round(F.percent_rank().over(w) * 1000000).cast("long").alias("percent"), F.avg(order).over(w.rowsBetween(-1, 1)).alias("around"))
