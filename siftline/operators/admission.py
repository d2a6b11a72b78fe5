"""JN-1..JN-4, H-1, H-2: who is admitted once, and who is a duplicate.

Admission in order is not two successive first-per-key steps: a row that loses claims nothing, so a
later row can still win with the other key.  The exact distributed form used here works in rounds:

* a row that is the earliest undecided row on *all* its keys is kept;
* a row that shares a key with a kept row is dropped;
* a row that is the earliest on all its keys but one settles that one, since it is kept unless the key is taken before its turn:
  every later row with that key is dropped, whichever of the two comes true;
* everything else waits for the next round.

Rounds alone would follow a chain (each row shares one key with the row before and the other with the row after) link by
link.  From the third round on chains are contracted: a row that is the earliest on one key and the second on the other
has exactly one row before it and is kept if and only if that one is not.  Pointers to it are doubled until they end at a row
that is kept in this round (its distance then decides) or at one that still waits for several others.

Only narrow rows (order and keys) take part.  Every round starts from a written table, per-key minima are
combined map-side, and hot keys are split off by :func:`siftline.operators.keys.attach`.  No step gathers rows in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from siftline.functions.text import canonical_text, digest, keyed
from siftline.operators.keys import attach, first_by
from siftline.operators.pin import pinned
from siftline.session import durable

# Rounds without contraction: most rows are decided in them, and chains only show in what is left.
PATIENCE = 2


def with_record_keys(records: DataFrame) -> DataFrame:
    """TXT-4: canonical text, record key, content key and identity hash of every record."""
    return (pinned(records, text=canonical_text(F.col("text")))
            .withColumn("record_key", keyed("record", F.col("source"), F.col("source_record_id")))
            .withColumn("content_key", F.concat(F.lit("content:"), digest(F.col("text"))))
            .withColumn("identity_hash", digest(F.concat_ws(":", "source", "identity"))))


def _contracted(marked: DataFrame, order: str, keys: list[str], total: int) -> DataFrame:
    """Orders of the rows that are kept because an even number of links leads from them to a winner of this round."""
    staged = marked
    for i, key in enumerate(keys):
        second = marked.filter(F.col(order) > F.col(f"_m{i}")).groupBy(key).agg(F.min(order).alias(f"_s{i}"), F.count(F.lit(1)).alias("n"))
        staged = attach(staged, second, key, total)
    pred = F.lit(None)
    for i in range(len(keys)):
        others = [F.col(order) == F.col(f"_m{k}") for k in range(len(keys)) if k != i]
        pred = F.when(reduce(lambda a, b: a & b, [F.col(order) == F.col(f"_s{i}"), *others]), F.col(f"_m{i}")).otherwise(pred)
    links = durable(staged.select(F.col(order).alias("_row"), pred.alias("_to"), F.lit(True).alias("_odd")).filter(F.col("_to").isNotNull()), "links")
    while True:
        ahead = links.select(F.col("_row").alias("_to"), F.col("_to").alias("_next"), F.col("_odd").alias("_more"))
        joined = links.join(ahead, "_to", "left")
        links = durable(joined.select("_row", F.coalesce("_next", "_to").alias("_to"), (F.col("_odd") != F.coalesce("_more", F.lit(False))).alias("_odd"),
                                      F.col("_next").isNotNull().alias("_moved")), "links")
        if not links.filter("_moved").limit(1).count():
            break
        links = links.drop("_moved")
    winners = marked.filter("_win").select(F.col(order).alias("_to"))
    return links.filter("NOT _odd").join(winners, "_to", "left_semi").select(F.col("_row").alias(order))


def greedy_claims(rows: DataFrame, order: str, keys: list[str], patience: int = PATIENCE) -> DataFrame:
    """Rows ``(order, *keys)`` kept by all-or-nothing claims taken in ``order`` (any sortable column)."""
    # later repeats of the same key combination can never win
    pool = durable(rows.groupBy(*keys).agg(F.min(order).alias(order)), "pool")
    kept: list[DataFrame] = []
    rounds = 0
    total = pool.count()
    while total:
        marked = pool
        for i, key in enumerate(keys):
            least = pool.groupBy(key).agg(F.min(order).alias(f"_m{i}"), F.count(F.lit(1)).alias("n"))
            least = least.withColumn(f"_n{i}", F.col("n"))
            marked = attach(marked, least, key, total)
        wins = reduce(lambda a, b: a & b, [F.col(order) == F.col(f"_m{i}") for i in range(len(keys))])
        marked = durable(marked.withColumn("_win", wins), "marked")
        winners = marked.filter("_win")
        if rounds >= patience:
            more = marked.join(_contracted(marked, order, keys, total), order, "left_semi")
            winners = durable(winners.unionByName(more), "winners")
        kept.append(winners.select(order, *keys))
        waiting = marked.filter("NOT _win").select(order, *keys)
        for i, key in enumerate(keys):
            others = reduce(lambda a, b: a & b, [F.col(order) == F.col(f"_m{k}") for k in range(len(keys)) if k != i], F.lit(True))
            # winners of this round are the earliest on this key too, those of contracted chains need not be
            ends = marked.filter(others).select(key, order, f"_n{i}", F.lit(False).alias("_taken"))
            if rounds >= patience:
                ends = ends.unionByName(winners.select(key, order, f"_n{i}", F.lit(True).alias("_taken")))
            ends = ends.groupBy(key).agg(F.min(order).alias(f"_e{i}"), F.max("_taken").alias(f"_t{i}"), F.max(f"_n{i}").alias("n"))
            waiting = attach(waiting, ends, key, total)
        open_ = [F.col(f"_e{i}").isNull() | (~F.col(f"_t{i}") & (F.col(order) <= F.col(f"_e{i}"))) for i in range(len(keys))]
        pool = durable(waiting.filter(reduce(lambda a, b: a & b, open_)).select(order, *keys), "pool")
        total = pool.count()
        rounds += 1
    if not kept:
        return pool.limit(0)
    return reduce(DataFrame.unionByName, [k.select(order, *keys) for k in kept])


def known_keys(keys: DataFrame, column: str, claimed: DataFrame) -> DataFrame:
    """Rows of ``keys`` whose ``column`` is not in the permanent key table."""
    return keys.join(claimed.select(F.col("key").alias(column)), column, "left_anti")


def admit(records: DataFrame, claimed: DataFrame | None = None, order: str = "pos") -> DataFrame:
    """JN-2 then JN-1: verdict ``stored`` or ``duplicate`` for every row, by its unique ``order``.

    Claims inside the batch come first and count even for a row that turns out to be known from earlier
    batches, exactly as one-by-one admission of a whole batch decides.
    """
    narrow = durable(records.select(order, "record_key", "content_key"), "keys")
    kept = greedy_claims(narrow, order, ["record_key", "content_key"])
    if claimed is not None:
        kept = known_keys(known_keys(kept, "record_key", claimed), "content_key", claimed)
    verdicts = narrow.select(order).join(kept.select(order, F.lit(True).alias("_kept")), order, "left")
    return verdicts.select(order, F.when(F.col("_kept"), F.lit("stored")).otherwise(F.lit("duplicate")).alias("verdict"))


def stored(records: DataFrame, verdicts: DataFrame, order: str = "pos") -> DataFrame:
    return records.join(verdicts.filter(F.col("verdict") == "stored").select(order), order, "left_semi")


def new_keys(records: DataFrame, as_of: Column) -> DataFrame:
    """Permanent keys of stored records, ready to be added to the key table."""
    return records.select(F.explode(F.array("record_key", "content_key")).alias("key"), as_of.alias("created_at"))


def with_known_contacts(records: DataFrame, claimed: DataFrame, row: str, contacts: str = "contacts") -> DataFrame:
    """JN-3: adds ``all_known``: the record has contacts and every one of them is already claimed."""
    each = records.select(row, F.explode(contacts).alias("c"))
    each = each.select(row, F.concat(F.lit("email:"), digest(F.col("c.email"))).alias("key"))
    seen = claimed.select("key", F.lit(True).alias("_seen"))
    flags = (each.join(seen, "key", "left").groupBy(row)
             .agg(F.bool_and(F.coalesce("_seen", F.lit(False))).alias("all_known")))
    return records.join(flags, row, "left").withColumn("all_known", F.coalesce("all_known", F.lit(False)))


def first_identities(records: DataFrame, claimed: DataFrame, order: str, identity: str = "identity_hash") -> DataFrame:
    """JN-4: one record per identity, the earliest, unless the identity has a lead or candidate key."""
    holders = claimed.filter(F.col("key").startswith("lead:") | F.col("key").startswith("candidate:"))
    holders = holders.select(F.substring_index("key", ":", -1).alias(identity)).distinct()
    firsts = first_by(records.join(holders, identity, "left_anti"), [identity], [order], [order])
    return records.join(firsts.select(order), order, "left_semi")


def finalise(candidates: DataFrame, claimed: DataFrame, contact_required: Column) -> DataFrame:
    """H-2: finals of qualified candidates ``(candidate_id, identity_hash, rank_score, score, created_at,
    contacts)``, where the first contact with a free address and a free identity wins.  ``claim_rank`` and
    ``claim_score``, where present, order the claims instead of the final rank and score.

    A candidate without contacts competes for its identity alone when no contact is required of it.
    """
    # best rank first, then score, then age; the id makes the order total
    rank, score = [f"claim_{c}" if f"claim_{c}" in candidates.columns else d for c, d in (("rank", "rank_score"), ("score", "score"))]
    bare = (F.size("contacts") == 0) & ~contact_required
    none = F.array(F.lit(None).cast(candidates.schema["contacts"].dataType.elementType))
    base = candidates.select("candidate_id", "identity_hash", bare.alias("_bare"), F.when(bare, none).otherwise(F.col("contacts")).alias("_slots"),
                             (-F.col(rank)).alias("_r"), (-F.col(score)).alias("_s"), F.col("created_at").alias("_c"))
    by = ["_r", "_s", "_c", "candidate_id"]
    # claims are numbered once, in sorted ranges and inside a candidate in order of its contacts: the least number of a key is a hash
    # aggregate, the least struct would sort all claims by their keys, round after round
    each = (base.repartitionByRange(*by).sortWithinPartitions(*by)
            .select("candidate_id", "identity_hash", "_bare", F.posexplode("_slots").alias("_slot", "contact")).withColumn("turn", F.monotonically_increasing_id()))
    email_key = F.when(F.col("_bare"), F.concat(F.lit("none:"), F.col("candidate_id").cast("string"))).otherwise(
        F.concat(F.lit("email:"), digest(F.col("contact.email"))))
    claims = durable(each.select("candidate_id", "turn", "contact", email_key.alias("email_key"), F.concat(F.lit("lead:"), F.col("identity_hash")).alias("lead_key")), "claims")
    free = known_keys(known_keys(claims.select("turn", "email_key", "lead_key"), "email_key", claimed), "lead_key", claimed)
    won = greedy_claims(free, "turn", ["email_key", "lead_key"])
    return (claims.join(won.select("turn"), "turn", "left_semi")
            .select("candidate_id", F.col("contact.email").alias("email"),
                    F.col("contact.source_url").alias("email_source_url"),
                    F.when(F.col("contact").isNotNull(), F.substring_index("email_key", ":", -1)).alias("email_hash")))
