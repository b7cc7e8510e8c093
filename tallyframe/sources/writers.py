"""Writers. Results are partitioned tables; lists without a size limit are child tables.

All tables of a result are one commit of a :class:`~tallyframe.sources.store.Store` at ``path``, read with its ``read``: a
reader meets the old result or the new one, and a write that is lost halfway leaves the old one. With ``batch``, a writer's
name and number, a write that is repeated after it was committed changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import naming as n
from ..operators import compare, rules, skew, vote
from ..session import cut_lineage
from .store import Conflict, Store


def write_canonical(
    votes: DataFrame, path: str, name: str, version: str, require=True, min_confidence: str | None = None,
    ballots: DataFrame | None = None, source: str | None = None, value: str | None = None, batch=None,
) -> DataFrame:
    """Write accepted votes (``messages``, by confidence), their ``sources`` and the ``manifest``; returns the counters as one row.

    The votes are worked out once. ``ballots`` (from :func:`vote.ballots`, with the columns ``source`` and
    ``value``) gives the sources of each record and its outliers with their fingerprints, as a table of its own
    partitioned by ``agrees``.
    """
    held = cut_lineage(votes)
    accepted = vote.filter_consensus(held, require, min_confidence)
    keyed = accepted.withColumn("file_key", n.canonical_key(name, version))
    parts = {"messages": keyed.drop("winning_order")}
    if ballots is not None:
        members = skew.null_safe_join(ballots, accepted.select(name, version), [name, version], "left_semi")
        parts["sources"] = members.select(name, version, F.col(source).alias("source"), F.col(value).alias("fingerprint"), "agrees")
    parts["manifest"] = keyed.select(
        "file_key", F.col("winning_value").alias("fingerprint"), "confidence",
        F.bround("confidence_score", 3).alias("confidence_score"),
        F.col("agreement_count").alias("sources"),
        (F.col("total_count") - F.col("agreement_count")).alias("outliers"),
    )
    by = {"messages": ["confidence"], "sources": ["agrees"]}
    Store(votes.sparkSession, path).commit(parts, batch, format="json", partition_by=by)
    return canonical_counters(held, require, min_confidence)


def canonical_counters(votes: DataFrame, require=True, min_confidence: str | None = None) -> DataFrame:
    floor = fixed.CONFIDENCE_ORDER.index(min_confidence) if min_confidence else 0
    no_consensus = ~F.col("has_consensus") if require else F.lit(False)
    low = vote.confidence_rank(F.col("confidence")) < floor
    return votes.agg(
        F.count_if(~no_consensus & ~low).alias("written"),
        F.count_if(no_consensus).alias("skipped_no_consensus"),
        F.count_if(~no_consensus & low).alias("skipped_low_confidence"),
    )


def write_preliminary(results: DataFrame, path: str, batch=None) -> DataFrame:
    """Write preliminary votes by status (``by_status``) and return how many there are of each."""
    held = cut_lineage(results)
    parts = {"by_status": held.drop("winning_order")}
    Store(results.sparkSession, path).commit(parts, batch, format="json", partition_by={"by_status": ["status"]})
    return held.groupBy("status").agg(F.count(F.lit(1)).alias("messages"))


#: Where decisions go.
FOLDERS = {"accepted": "canonical", "accepted_with_corrections": "canonical", "valid_variations": "variations", "needs_manual_review": "manual_review"}


def write_final(decisions: DataFrame, path: str, batch=None) -> DataFrame:
    """Write ``decisions``, worked out once, by list: canonical, variations and manual_review; returns the summary."""
    held = cut_lineage(decisions)
    place = F.create_map(*[F.lit(x) for pair in FOLDERS.items() for x in pair])[F.col("decision")]
    parts = {"decisions": held.drop("winning_order").withColumn("list", place)}
    Store(decisions.sparkSession, path).commit(parts, batch, format="json", partition_by={"decisions": ["list"]})
    return held.groupBy("decision", "confidence").agg(F.count(F.lit(1)).alias("messages"))


def write_keys(keys: DataFrame, groups: DataFrame, path: str, batch=None) -> None:
    """Write ``keys`` in order of name, dealt over tasks by ranges of names, and ``groups``."""
    Store(keys.sparkSession, path).commit({"keys": keys.orderBy("name"), "groups": groups}, batch, format="json")


def write_conflicts(conflicts: DataFrame, queue: DataFrame, path: str, batch=None) -> None:
    Store(conflicts.sparkSession, path).commit({"conflicts": conflicts, "queue": queue}, batch, format="json")


def append_new(new: DataFrame, path: str, key, force=False, batch=None, attempts: int = 5) -> DataFrame:
    """Append rows to the part ``rows`` whose key is not held yet (all of them with ``force``); returns what was appended.

    Where another writer commits in between, the rows it has added are left out in a new attempt.
    """
    store = Store(new.sparkSession, path)
    for attempt in range(attempts):
        state = store.state()
        if state.holds(batch):
            return new.limit(0)
        held = store.read("rows", state=state) if "rows" in state.parts else new.limit(0)
        added = cut_lineage(compare.remaining(new, held, key, force))
        try:
            store.commit({"rows": added}, batch, append=True, after=None if force else state.version)
            return added
        except Conflict:
            if attempt + 1 == attempts:
                raise


def record_variation(variations: DataFrame, path: str, batch=None) -> None:
    """Append to the part ``rows`` with the time of the record; with ``batch`` a repeated call adds nothing."""
    rows = variations.withColumn("recorded_at", F.current_timestamp())
    Store(variations.sparkSession, path).commit({"rows": rows}, batch, append=True)


def write_report(votes: DataFrame, path: str, entity, batch=None) -> None:
    """The validation report: ``summary``, ``results`` and the results with ``issues``, of votes worked out once."""
    votes = cut_lineage(votes)
    parts = {
        "summary": rules.validation_summary(votes),
        "results": rules.serialized(votes, entity),
        "issues": rules.serialized(rules.problem_votes(votes), entity),
    }
    Store(votes.sparkSession, path).commit(parts, batch, format="json")


def write_views(views: DataFrame, path: str, batch=None, append=False) -> None:
    """Write the wide view of decoded frames (:func:`codec.wide`) as ``views``, a partition per message."""
    Store(views.sparkSession, path).commit({"views": views}, batch, append=append, partition_by={"views": ["message"]})
