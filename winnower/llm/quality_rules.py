"""Quality rules as weak supervision.

Each rule votes for a document, against it, or abstains. Expectation-maximisation over the counts of vote patterns
estimates how often each rule votes right in either class, and a document is kept by its posterior probability of
being good rather than by passing every rule.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import BASE, SPACE, chunks, mix64, span_hashes, text_column, word_bounds
from .scratch import Scratch

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_distinct", "n_bangs")

#: Letters beyond ASCII; measured beside the counts, and not part of the result.
OTHER = "n_other"

FEATURES = ", ".join(f"{c} long" for c in (*COUNTS, OTHER))


@dataclass(frozen=True)
class Supervision:
    """What is expected of the rules beforehand; shares of all documents where nothing else is said."""
    #: Share of the good documents that a rule objects to.
    false_alarms: float = 0.001
    #: Share of a bad class that a rule of another class objects to, and what this weighs.
    others: float = 0.1
    weight: float = 0.002
    #: What a bad class costs, so that rarer votes against are taken for false alarms.
    cost: float = 0.0005
    #: Share of what each rule objects to and is not seen often enough for a class: documents that several rules object
    #: to belong there, however rare they are.
    least: float = 0.0002
    rounds: int = 1000


_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The counts of each row of a chunk, in the order of COUNTS."""
    rows = len(offsets) - 1
    out = np.zeros((rows, len(COUNTS)), dtype=np.int64)
    starts, ends, first = word_bounds(data, offsets)
    out[:, 0] = np.diff(first)
    if not len(data):
        return out
    out[:, 1] = _per_row(~SPACE[data] & ((data & 0xC0) != 0x80), offsets)
    out[:, 2] = _per_row(_SYMBOL[data], offsets)
    out[:, 6] = _per_row((data >= 65) & (data <= 90), offsets)
    out[:, 7] = _per_row((data >= 97) & (data <= 122), offsets)
    out[:, 9] = _per_row(data == 33, offsets)
    words = span_hashes(data, starts, ends)

    # Lines: between line feeds and the ends of rows.
    feeds = np.flatnonzero(data == 10)
    line_starts = np.concatenate((offsets[:-1], feeds + 1))
    line_ends = np.concatenate((offsets[1:], feeds))
    line_starts.sort()
    line_ends.sort()
    line_row = np.searchsorted(offsets, line_starts, side="right") - 1
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    # A line feed that ends a row opens an empty line at the start of the next row; it has no word.
    line_starts, line_ends, line_row = line_starts[filled], line_ends[filled], line_row[filled]
    lines = span_hashes(data, line_starts, line_ends)
    line_first = np.searchsorted(line_row, np.arange(rows + 1))
    out[:, 5] = np.diff(line_first)

    three = mix64(mix64(mix64(words[:-2]) * BASE + words[1:-1]) * BASE + words[2:]) if len(words) > 2 else words[:0]
    for r in range(rows):
        a, b = first[r], first[r + 1]
        own = lines[line_first[r]:line_first[r + 1]]
        if len(own) > 1:
            out[r, 3] = len(own) - len(np.unique(own))
        if b > a:
            out[r, 8] = len(np.unique(words[a:b]))
        if b - a >= 3:
            _, inverse, times = np.unique(three[a:b - 2], return_inverse=True, return_counts=True)
            twice = times[inverse] > 1
            covered = np.zeros(b - a, dtype=bool)
            for k in range(3):
                covered[k:b - a - 2 + k] |= twice
            out[r, 4] = np.count_nonzero(covered)
    return out


def other_letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many characters beyond ASCII each row has, without the signs and marks of U+0080-U+00BF, U+2000-U+2BFF,
    U+3000-U+303F and U+1F000-U+1FFFF."""
    if not len(data):
        return np.zeros(len(offsets) - 1, dtype=np.int64)
    after = np.append(data[1:], np.uint8(0))
    marks = (data == 0xC2) | ((data == 0xE2) & (after < 0xB0)) | ((data == 0xE3) & (after == 0x80)) | ((data == 0xF0) & (after == 0x9F))
    return _per_row((data >= 0xC0) & ~marks, offsets)


def _measure(carry: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch, "_text")
            for start, end in chunks(offsets):
                own = offsets[start:end + 1]
                found, other = (f(data[own[0]:own[-1]], own - own[0]) for f in (counts, other_letters))
                yield pa.record_batch([*(batch.column(c).slice(start, end - start) for c in carry), *map(pa.array, found.T.copy()), pa.array(other)], names=[*carry, *COUNTS, OTHER])

    return run


def features(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The carried columns, as _0, _1 ..., the counts and the letters beyond ASCII, for each row; null text has zero of everything."""
    held = [f"_{k}" for k in range(len(carry))]
    rows = docs.select(*[F.col(c).alias(h) for c, h in zip(carry, held, strict=True)], F.col("text").alias("_text"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_measure(held), ", ".join([*(f"{h} {kinds[h]}" for h in held), FEATURES]))


def _vote(bad: Column, good: Column) -> Column:
    """0 against, 1 abstains, 2 for."""
    return F.when(bad, 0).when(good, 2).otherwise(1)


def votes() -> dict[str, Column]:
    """The rules. Between its two bounds a rule abstains."""
    c = F.col
    words = F.greatest(c("n_words"), F.lit(1))
    letters = F.greatest(c("n_upper") + c("n_lower"), F.lit(1))
    # Where most letters are of other alphabets, the few ASCII ones are names and abbreviations.
    latin = c("n_upper") + c("n_lower") >= c("n_other")
    return {
        "length": _vote(c("n_words") < 30, c("n_words").between(50, 100_000)),
        "word_length": _vote((c("word_chars") < 2 * words) | (c("word_chars") > 14 * words), (c("word_chars") > 3 * words) & (c("word_chars") < 10 * words)),
        "symbols": _vote(10 * c("n_symbols") > words, 50 * c("n_symbols") <= words),
        "lines": _vote(10 * c("n_dup_lines") > 5 * c("n_lines"), 20 * c("n_dup_lines") <= c("n_lines")),
        "repeats": _vote(100 * c("n_repeat_words") > 30 * words, 100 * c("n_repeat_words") <= 15 * words),
        "capitals": _vote(latin & (10 * c("n_upper") > 3 * letters), latin & (10 * c("n_upper") <= letters)),
        "variety": _vote(c("n_distinct") * c("n_distinct") < words, c("n_distinct") * c("n_distinct") >= 4 * words),
        "bangs": _vote(10 * c("n_bangs") > words, 50 * c("n_bangs") <= words),
    }


def posterior(patterns: np.ndarray, share: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Probability of each vote pattern's documents being good; an abstention says nothing.

    share: of each class, the good one first; right: how often a rule's vote in a class is the one expected there, for
    good documents (row 0) a vote for, for bad ones a vote against. Without a vote against it is one.
    """
    return _classes(patterns, share, right)[:, 0]


def _classes(patterns: np.ndarray, share: np.ndarray, right: np.ndarray) -> np.ndarray:
    against, for_ = (patterns == 0).astype(float), (patterns == 2).astype(float)
    says = np.concatenate((1 - right[:1], right[1:]))
    odds = against @ np.log(says).T + for_ @ np.log(1 - says).T + np.log(np.maximum(share, 1e-300))
    odds = np.exp(odds - odds.max(1, keepdims=True))
    # What no rule objects to is good.
    odds[:, 1:] *= against.any(1, keepdims=True)
    odds[~against.any(1), 0] = 1
    return odds / odds.sum(1, keepdims=True)


def estimate(patterns: np.ndarray, number: np.ndarray, p: Supervision = Supervision()) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns.

    patterns: a row of votes (0, 1, 2) each; number: how many documents have it. There is a class of good documents and
    for each rule one of bad documents, which that rule speaks against: rules see their own kinds of bad documents only,
    and one class of all kinds would have to give up the good votes to hold them. A second class of each rule is not
    learned and stands for what is not seen yet. Returns the shares of the classes and the rules' accuracies in them. It
    starts from bad where any rule votes against, as rules rarely speak against prose.

    What is expected beforehand weighs as shares of all documents, so the same shares give the same verdicts at any number.
    """
    rules = patterns.shape[1]
    against, for_ = (patterns == 0).astype(float), (patterns == 2).astype(float)
    objecting = against.sum(1, keepdims=True)
    post = np.concatenate((np.where(objecting > 0, 0.05, 1.0), 0.95 * against / np.maximum(objecting, 1), 0 * against), axis=1)
    total = number.sum()
    number, own = number / total if total > 0 else np.zeros(len(number)), np.arange(rules)
    for _ in range(p.rounds):
        held = post.T[:1 + rules] * number
        no, yes = held @ against, held @ for_
        # Votes against good documents are rare, which weighs as much as all documents seen; else a rule that alone
        # speaks up could not be told right. The same holds votes for what is of a rule's own class, so that class
        # cannot grow over documents that the rule does not object to.
        good = (yes[:1] + 1 - p.false_alarms) / (no[:1] + yes[:1] + 1)
        # No rule objects to the bad less often than to the good, so one more vote against never speaks for a document.
        right = np.concatenate((good, np.maximum((no[1:] + p.others * p.weight) / (no[1:] + yes[1:] + p.weight), 1 - good)))
        right[1 + own, own] = (no[1 + own, own] + 1 - p.false_alarms) / (no[1 + own, own] + yes[1 + own, own] + 1)
        unseen = np.tile(np.maximum(p.others, 1 - good), (rules, 1))
        unseen[own, own] = 1 - p.false_alarms
        right = np.concatenate((right, unseen))
        # Stray votes do not make a class.
        share = np.concatenate(([held[0].sum() + p.least], np.maximum(held[1:].sum(1) - p.cost, 0), np.full(rules, p.least)))
        share /= share.sum()
        new = _classes(patterns, share, right)
        change, post = np.abs(new - post).max(initial=0), new
        if change < 1e-9:
            break
    return share, right


def quality_rules(docs: DataFrame, keep_at: float = 0.5, carry: Sequence[str] = ("doc_id",), scratch: Scratch | None = None) -> DataFrame:
    """The carried columns, the counts, base_failed, the votes, quality (posterior) and kept, for each row of docs.

    base_failed: fewer than 50 words, or over half of the words in repeated three-word windows. kept: not base_failed
    and a posterior of keep_at or more. Null and empty texts have no words and fail. An empty table gives an empty one.
    Repeated rows count as often as they are there. Carried columns named like a count are left out of the result.

    The first pass counts vote patterns; with more than the id to carry, the second measures the texts again instead of
    joining them, so no text is shuffled.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "quality-rules")
    rules = votes()
    ids = [c for c in carry if c not in COUNTS and c != "text"] if len(carry) <= 1 else []
    slim = scratch.table(features(docs, ids).withColumns({f"vote_{k}": v for k, v in rules.items()}), "votes")
    voted = slim if len(carry) <= 1 else features(docs, carry).withColumns({f"vote_{k}": v for k, v in rules.items()})
    names = ids if len(carry) <= 1 else list(carry)
    code = sum((F.col(f"vote_{k}") * 3 ** i for i, k in enumerate(rules)), F.lit(0)).cast("int")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # At most 3 ** 8 patterns, whatever the number of documents. Rules are judged on the documents that pass the base.
    seen = slim.groupBy(code.alias("pattern")).agg(F.count(F.when(~base, 1)).alias("n")).toPandas().sort_values("pattern")
    patterns = np.array([[p // 3 ** i % 3 for i in range(len(rules))] for p in seen["pattern"]], dtype=np.int64).reshape(len(seen), len(rules))
    post = posterior(patterns, *estimate(patterns, seen["n"].to_numpy(dtype=float)))
    table = spark.createDataFrame([(int(p), float(q)) for p, q in zip(seen["pattern"], post, strict=True)], "pattern int, quality double")
    judged = (voted.withColumn("pattern", code).join(F.broadcast(table), "pattern", "left").withColumn("base_failed", base)
              .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_at)).drop("pattern"))
    own = {*COUNTS, "base_failed", "quality", "kept", *(f"vote_{k}" for k in rules)}
    return judged.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(names) if c not in own], *[c for c in judged.columns if c in own])
