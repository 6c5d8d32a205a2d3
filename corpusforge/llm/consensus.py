"""One label per item from disagreeing annotators, by message passing on the label edges.

Items and annotators form a bipartite graph with one edge per judgement. For each class against the
rest, every edge carries two messages. Item to annotator: the probability that the item is of the
class, from the class's prior and all *other* edges of the item. Annotator to item: how much this
annotator's vote says for or against the class, the log ratio of hit and false-alarm rates counted
over all *other* items of the annotator, each weighted by the message of its edge. The rounds go on
until the probabilities move by less than `tolerance` on average. Spammers end with a log ratio of
zero and annotators who answer contrary to the truth with a negative one.

Each round is two keyed sums with partial aggregation, joined back to the edges; sums of a few
numbers per key are all that is grouped, so an item or annotator with a third of all rows is no
problem. Sums are broadcast only if they have at most `broadcast_rows` rows; else the join is
shuffled, and the hot side split by the adaptive engine. A round writes the item-to-annotator messages and
the two sums to the shared folder (annotator-to-item messages follow from these) and deletes those of the round before.

Defined cases: rows without item, annotator or judgement, and blank ones, are left out; unknown
spellings count as Unsure; names are compared without case and outer blanks; of several rows of an
annotator for an item the latest `updated_at` holds, then the larger id; an item with one judgement
gets that judgement unless the annotator proves contrary; ties go to more votes, then Yes, No, Unsure.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusforge.session import discard, is_small, materialize

CLASSES = ("Yes", "No", "Unsure")
HONEST = 8.0

#: Spellings, compared in lower case without outer blanks and marks.
YES = ("yes", "y", "yeah", "yep", "yup", "ja", "si", "oui", "true", "t", "1", "ok", "agree", "agreed", "correct", "positive", "accept", "✓", "✔", "+")
NO = ("no", "n", "nope", "nah", "nein", "non", "false", "f", "0", "disagree", "disagreed", "incorrect", "wrong", "negative", "reject", "✗", "✘", "x", "-")


def judgement_class(raw: Column) -> Column:
    """0, 1 or 2 for Yes, No or Unsure; null for null and blank."""
    text = F.lower(F.regexp_replace(raw, r"(?U)^[\s.,;:!\"'()\[\]*_]+|[\s.,;:!\"'()\[\]*_]+$", ""))
    bare = F.regexp_replace(raw, r"(?U)\s", "")
    return (
        F.when(raw.isNull() | (bare == ""), None)
        .when(text.isin(*YES) | text.rlike(r"^(definitely |clearly |certainly |i think )?yes\b"), 0)
        .when(text.isin(*NO) | text.rlike(r"^(definitely |clearly |certainly |i think )?no(?!t)\b"), 1)
        .otherwise(2)
    )


def annotator_name(raw: Column) -> Column:
    return F.lower(F.regexp_replace(raw, r"(?U)^\s+|\s+$", ""))


def label_edges(df: DataFrame, item: list[str], annotator: str = "reviewer_username", judgement: str = "judgement", when: str = "updated_at", row_id: str = "id") -> DataFrame:
    """(item columns, annotator, label): the judgement that holds of every annotator for every item."""
    rows = df.select(*item, annotator_name(F.col(annotator)).alias("annotator"), judgement_class(F.col(judgement)).alias("label"), F.col(when).alias("when"), F.col(row_id).alias("row_id"))
    rows = rows.where(F.col("label").isNotNull() & (F.col("annotator") != "") & F.expr(" and ".join(f"`{c}` is not null" for c in item)))
    return rows.groupBy(*item, "annotator").agg(F.max(F.struct("when", "row_id", "label"))["label"].alias("label"))


def _joined(edges: DataFrame, sums: DataFrame, on: list[str], small: bool) -> DataFrame:
    return edges.join(F.broadcast(sums) if small else sums, on)


def message_passing(edges: DataFrame, item: list[str], rounds: int = 25, tolerance: float = 2e-4, weight: float = 2.0, broadcast_rows: int = 200_000) -> DataFrame:
    """Edges with the last messages: columns p (array by class, item to annotator), v (array by class, annotator to item), s (item sums of v), prior."""
    n = len(CLASSES)
    is_class = lambda c: (F.col("label") == c).cast("double")
    item_votes = edges.groupBy(*item).agg(F.count("*").alias("m"), *[F.sum(is_class(c)).alias(f"k{c}") for c in range(n)])
    totals = edges.agg(F.count("*").alias("m"), *[F.sum(is_class(c)).alias(f"k{c}") for c in range(n)]).first()
    if not totals["m"]:
        return edges.select("*", *[F.array(*[F.lit(0.0)] * n).alias(x) for x in ("p", "v", "s", "odds")])
    prior = [min(0.999, max(0.001, totals[f"k{c}"] / totals["m"])) for c in range(n)]
    share = list(prior)
    start = edges.join(item_votes, item)
    state = materialize(start.select(*edges.columns, *[((F.col(f"k{c}") - is_class(c) + prior[c]) / F.col("m")).alias(f"p{c}") for c in range(n)]), "beliefs")
    kept: list[DataFrame] = []
    few: dict[str, bool] = {}  # whether annotators and items are few enough to broadcast; their numbers stay the same in all rounds
    for turn in range(rounds):
        hit = [F.sum(F.col(f"p{c}") * is_class(c)).alias(f"h{c}") for c in range(n)]
        of = [F.sum(f"p{c}").alias(f"t{c}") for c in range(n)]
        alarm = [F.sum((1 - F.col(f"p{c}")) * is_class(c)).alias(f"a{c}") for c in range(n)]
        worth = materialize(state.groupBy("annotator").agg(F.count("*").alias("m"), *hit, *of, *alarm), "worth")
        pooled = worth.agg(*[F.sum(x).alias(x) for x in ["m"] + [f"{k}{c}" for k in "hta" for c in range(n)]]).first()
        # What of the rates is the same for all edges of an annotator is worked out once for it. The common rates are started from honest
        # annotators: HONEST votes that any real number of them outweighs.
        rates = ["annotator"]
        for c in range(n):
            mean_hit = (pooled[f"h{c}"] + 0.8 * HONEST) / (pooled[f"t{c}"] + HONEST)
            mean_alarm = (pooled[f"a{c}"] + 0.15 * HONEST) / (pooled["m"] - pooled[f"t{c}"] + HONEST)
            rates += [(F.col(f"h{c}") + weight * mean_hit).alias(f"h{c}"), (F.col(f"t{c}") + weight).alias(f"t{c}"), (F.col(f"a{c}") + weight * mean_alarm).alias(f"a{c}"), (F.col("m") - F.col(f"t{c}") + weight).alias(f"f{c}")]
        votes = []
        for c in range(n):
            p, own = F.col(f"p{c}"), F.col("label") == c
            bound = lambda x: F.greatest(F.lit(0.005), F.least(F.lit(0.995), x))
            said = bound((F.col(f"h{c}") - p) / (F.col(f"t{c}") - p)), bound((F.col(f"a{c}") - 1 + p) / (F.col(f"f{c}") - 1 + p))
            kept_from = bound(F.col(f"h{c}") / (F.col(f"t{c}") - p)), bound(F.col(f"a{c}") / (F.col(f"f{c}") - 1 + p))
            votes.append(F.log(F.when(own, said[0] / said[1]).otherwise((1 - kept_from[0]) / (1 - kept_from[1]))).alias(f"v{c}"))
        if not few:
            few["annotators"] = is_small(worth, broadcast_rows)
        sent = _joined(state, worth.select(*rates), ["annotator"], few["annotators"]).select(*edges.columns, *[f"p{c}" for c in range(n)], *votes)
        sums = materialize(sent.groupBy(*item).agg(*[F.sum(f"v{c}").alias(f"s{c}") for c in range(n)]), "sums")
        few["items"] = few["items"] if "items" in few else is_small(sums, broadcast_rows)
        back = _joined(sent, sums, item, few["items"])
        prior = [min(0.999, max(0.001, (pooled[f"t{c}"] + HONEST * share[c]) / (pooled["m"] + HONEST))) for c in range(n)]
        logit = [math.log(q / (1 - q)) for q in prior]
        new = [1 / (1 + F.exp(-(F.lit(logit[c]) + F.col(f"s{c}") - F.col(f"v{c}")))) for c in range(n)]
        moves = Observation()
        told = back.select(*edges.columns, *[f"p{c}" for c in range(n)], *[q.alias(f"q{c}") for c, q in enumerate(new)])
        told = told.observe(moves, *[F.avg(F.abs(F.col(f"q{c}") - F.col(f"p{c}"))).alias(f"d{c}") for c in range(n)])
        after = materialize(told.select(*edges.columns, *[F.col(f"q{c}").alias(f"p{c}") for c in range(n)]), "beliefs")
        done = back.select(*edges.columns, *[q.alias(f"q{c}") for c, q in enumerate(new)], *[f"{k}{c}" for k in "vs" for c in range(n)])
        if turn + 1 == rounds or max(moves.get[f"d{c}"] for c in range(n)) < tolerance:
            break
        discard(state, *kept)
        state, kept = after, [worth, sums]
    arrays = [F.array(*[f"{k}{c}" for c in range(n)]).alias(k) for k in "vs"]
    odds = F.array(*[F.col(f"s{c}") + logit[c] for c in range(n)]).alias("odds")
    return done.select(*edges.columns, F.array(*[f"q{c}" for c in range(n)]).alias("p"), *arrays, odds)


def consensus(edges: DataFrame, item: list[str], **options) -> tuple[DataFrame, DataFrame]:
    """(items, annotators).

    items: item columns, judgement, confidence, n_judgements, agreement (share of the item's
    annotators who gave the label). annotators: annotator, n_judgements, reliability (mean probability
    of the labels given, each judged by the other annotators), weight (mean log ratio of the votes).
    """
    done = materialize(message_passing(edges, item, **options), "consensus")
    n = len(CLASSES)
    items = done.groupBy(*item).agg(
        F.count("*").alias("n_judgements"),
        *[F.max(F.col("odds")[c]).alias(f"o{c}") for c in range(n)],
        *[F.sum((F.col("label") == c).cast("double")).alias(f"k{c}") for c in range(n)],
    )
    best = F.greatest(*[F.struct(F.round(f"o{c}", 9).alias("odds"), F.col(f"k{c}").alias("votes"), F.lit(-c).alias("rank")) for c in range(n)])
    items = items.withColumn("best", best).withColumn("c", -F.col("best.rank"))
    mass = [1 / (1 + F.exp(-F.col(f"o{c}"))) for c in range(n)]
    items = items.select(
        *item,
        F.array(*map(F.lit, CLASSES))[F.col("c")].alias("judgement"),
        (1 / (1 + F.exp(-F.col("best.odds"))) / (mass[0] + mass[1] + mass[2])).alias("confidence"),
        "n_judgements",
        (F.col("best.votes") / F.col("n_judgements")).alias("agreement"),
    )
    annotators = done.groupBy("annotator").agg(F.count("*").alias("n_judgements"), F.avg(F.col("p")[F.col("label")]).alias("reliability"), F.avg(F.col("v")[F.col("label")]).alias("weight"))
    return items, annotators
