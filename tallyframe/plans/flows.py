"""The operators in the order they are used: from documents to a registry, keys and decoded captures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import codec, keys, layout, merge, skew, vote
from ..session import cut_lineage
from ..sources import readers


def preliminary_votes(extractions: DataFrame) -> DataFrame:
    """Extractions grouped by (message, version) and voted on; sources in name order."""
    return vote.preliminary(extractions, ["message_name", "protocol_version"], "fingerprint", ["manual"])


def consensus(extractions: DataFrame) -> DataFrame:
    """Consensus over extraction bundles in reading order, with the winning structure."""
    entity = ["message_name", "protocol_version"]
    votes = vote.vote(extractions, entity, "fingerprint", ["seq"])
    return vote.with_winning_row(votes, extractions, entity, ["seq"], ["structure"])


def outlier_report(fields: DataFrame, entity, source: str, name: str, offset: str, dtype: str, size: str, order) -> DataFrame:
    """Outliers with what sets them apart: (entity.., source, winning_source, mismatch_count, field_count_diff, summary).

    ``fields`` has a row per field of each source's layout. Sources vote by their layout's fingerprint; each one
    that does not agree is compared, field by field, with the first source that does.
    """
    keys = [*entity, source]
    prints = cut_lineage(layout.fingerprint(fields, keys, name, offset, dtype, size))
    votes = vote.vote(prints, entity, "fingerprint", [source])
    won = votes.select(*entity, "winning_value", F.col("winning_order")[source].alias("winning_source"))
    # Sources that agree have equally many fields.
    ballots = skew.null_safe_join(prints, won, entity, "inner").withColumn("_agrees", F.col("fingerprint").eqNullSafe(F.col("winning_value")))
    counts = ballots.where("_agrees").groupBy(*entity).agg(F.min("field_count").alias("_n"))
    out = skew.null_safe_join(ballots.where("NOT _agrees"), counts, entity, "left")
    sized = cut_lineage(out.select(*keys, "winning_source", (F.col("_n") - F.col("field_count")).alias("field_count_diff")))
    # Each outlier names the two sources whose fields are compared; the fields are read once more for both.
    sides = F.array(F.struct(F.col("winning_source").alias(source), F.lit(True).alias("_first")), F.struct(F.col(source).alias(source), F.lit(False).alias("_first")))
    wanted = sized.select(*entity, F.col(source).alias("_outlier"), F.inline(sides))
    compared = skew.null_safe_join(fields, wanted, keys, "inner")
    diff = layout.sided_differences(compared, "_first", [*entity, "_outlier"], offset, name, dtype, size, order).withColumnRenamed("_outlier", source)
    return layout.summarize(diff, keys, offset, name, dtype, sized, ["winning_source"])


def consensus_merged(
    items: DataFrame, entity, value: str, order, field_key, key, text: str, columns, reserved: str | None = None
) -> DataFrame:
    """Child items of the winner's fields, merged over the sources that agree with it.

    ``items`` has a row per source's item with the ``value`` the source votes for; ``order`` tells which source
    was first. The fields are those of the winning row; of each item the longest ``text`` stays.
    """
    votes = vote.vote(items, entity, value, order)
    agreeing = vote.ballots(items, votes, entity, value).where("agrees")
    first = votes.select(*entity, *[F.col("winning_order")[c].alias(c) for c in order])
    winners = skew.null_safe_join(agreeing, first, [*entity, *order], "left_semi")
    return merge.merge_children(winners, agreeing, entity, field_key, key, text, order, columns, reserved=reserved)


def final_decisions(reviewed: DataFrame) -> DataFrame:
    """Reviewed extractions decided per (message, version)."""
    return vote.determine(reviewed, ["message_name", "protocol_version"], "fingerprint", "verdict", ["manual"], "review_confidence")


def merged_keys(loaded: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Key bundles merged by id: (compliant keys, enumeration values, sources per key)."""
    named = loaded.where("name <> ''")
    merged = merge.provenance(
        named, ["key_id"], "source", ["seq"], first=["name", "data_type", "scale", "unit"], longest=["description"]
    )
    items = keys.valid_enum_items(readers.key_enum_items(named), "value")
    enum = merge.enum_union(items, ["key_id"], "name", "value", ["seq"], columns=["description"])
    return keys.compliant(merged), enum, merge.members(named, ["key_id"], "source")


def decoded_capture(captures: DataFrame, messages: DataFrame, fields: DataFrame, variants: DataFrame | None = None) -> DataFrame:
    """Capture files scanned, checked and decoded against a registry."""
    frames = codec.header(codec.scan(captures, "capture", "data"))
    found = codec.identify(frames.where(F.col("status") == "ok"), codec.layouts(messages, fields, variants))
    return codec.decode(found, ["capture", "offset"])
