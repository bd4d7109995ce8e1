"""What the filters of a chain remove alone, together and in every order.

Filters are players of a game: a coalition's value is the number of documents that at least one of its filters removes.
The potential of a coalition is its value plus the potentials of the coalitions with one filter less, divided by its
size. A filter's Shapley value is the potential of all filters less that of all but this one, and what a filter removes
at its place in an order is the difference of two coalitions. So 2^k values a part give all k! orders.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: SQL conditions under which a filter removes a document, by the filter's letter: `text` is not null, `words` its words.
RULES: dict[str, str] = {
    "A": "size(words) < 100",
    "B": "100 * size(array_distinct(words)) < 80 * size(words)",
    "C": "100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(text)",
    "D": "text RLIKE '[#$%&*|]'",
}
#: The filter that removes a text which a smaller doc_id has too.
COPIES = "E"

MEASURES = ("n", "good", "toxic")


def failed_sets(docs: DataFrame, labels: DataFrame, rules: Mapping[str, str] = RULES, copies: str = COPIES) -> DataFrame:
    """(part, mask, n, good, toxic): documents of a lang value by the set of filters they fail, a bit for each filter.

    The rules' bits come first, in their order, then that of the copies. Texts are compared by SHA-256. Only digests are
    shuffled, and copies are counted in each task first, so a group of copies of any size is a few rows.
    """
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text)
    rows = rows.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    mask = sum((F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(rules.values())), F.lit(0))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))
    # Rows without an id meet no label; their digests spread them over the tasks.
    rows = rows.withColumns({"key": F.coalesce("doc_id", F.xxhash64("digest")), "known": F.col("doc_id").isNotNull()})
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    told = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("key")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic")).withColumn("known", F.lit(True))
    rows = rows.join(told, ["key", "known"], "left").fillna(0, ["good", "toxic"])

    kind = ["digest", "part", "mask", "good", "toxic"]
    each = rows.groupBy("key", "known", "doc_id", *kind).agg(F.count("*").alias("n"))
    kinds = each.groupBy(*kind).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"))
    # A text has one mask, so its rows are at most four for each lang value.
    kinds = kinds.withColumn("least", F.min("first.doc_id").over(Window.partitionBy("digest")))
    stay = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    bit = 1 << len(rules)
    cells = kinds.select("part", "good", "toxic", F.explode(F.array(F.struct(F.col("mask"), stay.alias("n")), F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - stay).alias("n")))).alias("cell"))
    count = F.col("cell.n")
    return cells.groupBy("part", F.col("cell.mask").alias("mask")).agg(F.sum(count).alias("n"), F.sum(count * F.col("good")).alias("good"), F.sum(count * F.col("toxic")).alias("toxic")).where("n > 0")


def coalition_values(sets: DataFrame, players: int) -> DataFrame:
    """A row for each part: its documents in `total`, and `<measure>_<coalition>`, those that the coalition removes."""
    hit = lambda c: F.col("mask").bitwiseAND(F.lit(c)) != 0
    sums = [F.coalesce(F.sum(F.when(hit(c), F.col(m))), F.lit(0)).alias(f"{m}_{c}") for c in range(1 << players) for m in MEASURES]
    return sets.groupBy("part").agg(F.sum("n").alias("total"), *sums)


def potentials(values: DataFrame, players: int) -> DataFrame:
    """Adds `q_<coalition>`: the potential of the removal game times the factorial of the coalition's size, a whole number.

    As size! * P = (size - 1)! * (value + sum of P without one filter), each size follows from the one below.
    """
    out = values.withColumn("q_0", F.lit(0).cast("long"))
    for size in range(1, players + 1):
        of_size = [c for c in range(1 << players) if c.bit_count() == size]
        out = out.withColumns({f"q_{c}": sum((F.col(f"q_{c ^ (1 << k)}") for k in range(players) if c >> k & 1), factorial(size - 1) * F.col(f"n_{c}")) for c in of_size})
    return out


def steps(letters: str) -> Column:
    """An array of every step of every order: the order, the step, its filter, and the coalition before it."""
    rows = [
        {"filter_order": "".join(letters[k] for k in order), "step": at + 1, "player": k, "before": sum(1 << j for j in order[:at])}
        for order in permutations(range(len(letters))) for at, k in enumerate(order)
    ]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order string, step int, player int, before int>>")


def audit(docs: DataFrame, labels: DataFrame, rules: Mapping[str, str] = RULES, copies: str = COPIES) -> DataFrame:
    """A row for each part (lang; null counts as empty), order of the filters and step, with counts of documents.

    kept: left after this step; removed: by it; redundant: fail its filter but went earlier; unique_fails: fail no other
    filter; good_lost, toxic_lost: removed here with such a label; shapley: removed by this filter, summed over all
    orders, from the potentials. docs has doc_id, text and lang, labels doc_id, quality and toxic; other columns do not
    matter. A null text counts as empty. Repeated rows count each; rows with the smallest doc_id of a text, and rows
    without an id, are no copies. A document is good or toxic if any of its labels says so. No documents give no rows.
    """
    letters = "".join(rules) + copies
    players = len(letters)
    every = (1 << players) - 1
    parts = potentials(coalition_values(failed_sets(docs, labels, rules, copies), players), players)
    arrays = [F.array(*(F.col(f"{m}_{c}") for c in range(every + 1))).alias(m) for m in MEASURES]
    shapley = F.array(*(F.col(f"q_{every}") - players * F.col(f"q_{every ^ (1 << k)}") for k in range(players))).alias("shapley")
    rows = parts.select("part", "total", *arrays, shapley, F.explode(steps(letters)).alias("s"))
    alone = F.expr("shiftleft(1, s.player)")
    before = F.col("s.before")
    after = before + alone
    lost = lambda m: F.get(m, after) - F.get(m, before)
    return rows.select(
        "part", "s.filter_order", "s.step",
        (F.col("total") - F.get("n", after)).alias("kept"),
        lost("n").alias("removed"),
        (F.get("n", alone) - lost("n")).alias("redundant"),
        (F.get("n", F.lit(every)) - F.get("n", F.lit(every) - alone)).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("shapley", F.col("s.player")).alias("shapley"),
    )
