"""Class-based scores against a plain version of the counts, the exchange and the formula."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import corpora
import numpy as np
import pytest
import xxhash

from winnower.llm.class_model import ClassModel, Scorer, _pack, _unpack, score_documents

END = None
SMALL = ClassModel(classes=5, core=40, rounds=3, block=4096, shard=64)


def tokens_of(text: str | None) -> list[str]:
    return corpora.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def held(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def f(x: float) -> float:
    return x * math.log(max(x, 1))


def plain(rows: list[tuple], p: ClassModel) -> list[tuple]:
    streams = [tokens_of(t) for i, t in rows if not held(i)]
    counts = Counter(w for s in streams for w in s)
    key = {w: int(np.uint64(xxhash.xxh3_64_intdigest(w.encode())).view(np.int64)) for w in counts}
    core = sorted(counts, key=lambda w: (-counts[w], key[w]))[:p.core]
    pairs = Counter(pair for s in streams for pair in zip([END, *s], [*s, END]))
    others, end = p.classes, p.classes + 1
    of = {w: k if k < p.classes else others for k, w in enumerate(core)}
    context = lambda w, known: end if w is END else known.get(w, others)

    def profiles(known):
        out = {w: [[0] * (p.classes + 2) for _ in range(2)] for w in counts}
        for (a, b), n in pairs.items():
            if b is not END:
                out[b][0][context(a, known)] += n
            if a is not END:
                out[a][1][context(b, known)] += n
        return out

    def worth(sums):
        return sum(f(n) for side in sums for n in side) - 2 * f(sum(sums[0]))

    for _ in range(p.rounds):
        seen = profiles(of)
        sums = [[[sum(seen[w][side][c] for w in core if of[w] == k) for c in range(p.classes + 2)] for side in range(2)] for k in range(p.classes)]
        add = lambda s, w, sign: [[n + sign * m for n, m in zip(x, y)] for x, y in zip(s, seen[w])]  # noqa: E731, B023
        now = dict(of)
        for w in core:
            if now[w] < others:
                sums[now[w]] = add(sums[now[w]], w, -1)
            gains = [round(worth(add(s, w, 1)) - worth(s), 7) for s in sums]
            now[w] = gains.index(max(gains))
            sums[now[w]] = add(sums[now[w]], w, 1)
        of = now
    seen = profiles(of)
    total = [[sum(sums[k][side][c] for k in range(p.classes)) for c in range(p.classes + 2)] for side in range(2)]
    share = [[(n + 1) / (sum(side) + p.classes + 2) for n in side] for side in total]
    chance = lambda k, side, c: math.log((sums[k][side][c] + share[side][c]) / (sum(sums[k][side]) + 1))
    final = dict(of)
    for w in counts:
        if w not in of:
            fits = [round(sum(n * chance(k, side, c) for side in range(2) for c, n in enumerate(seen[w][side]) if n), 7) for k in range(p.classes)]
            final[w] = fits.index(max(fits))

    documents = len(streams)
    size, vocabulary = sum(counts.values()) + documents, len(counts) + (documents > 0)
    group = lambda w: p.classes if w is END else final[w]
    moves = Counter()
    for (a, b), n in pairs.items():
        moves[group(a), group(b)] += n
    of_class = Counter()
    for w, n in counts.items():
        of_class[final[w]] += n
    of_class[p.classes] = documents
    members = Counter(final.values())
    left = Counter()
    for (a, _), n in moves.items():
        left[a] += n

    def after(a, b):
        overall = of_class[b] / size
        return overall if a == "unseen" else (moves[a, b] + p.prior * overall) / (left[a] + p.prior)

    out = []
    for i, text in rows:
        words, before, score, base, known = tokens_of(text), p.classes, 0.0, 0.0, 0
        for w in [*words, END]:
            c = documents if w is END else counts[w]
            now = "unseen" if not c else group(w)
            rest = sum(after(before, k) * p.discount * members[k] / of_class[k] for k in range(p.classes) if of_class[k]) / (vocabulary + 1)
            emitted = 0 if not c else 1 if w is END else (c - p.discount) / of_class[now]
            score += math.log10((after(before, now) * emitted if c else 0) + rest)
            base += math.log10((c + 1) / (size + vocabulary + 1))
            known += c > 0
            before = now
        out.append((i, held(i), len(words) + 1, known, size, base, score))
    return out


@pytest.mark.parametrize("p", [SMALL, ClassModel(classes=3, core=10, rounds=1, block=1 << 20, shard=1 << 18)])
def test_scores_equal_a_plain_version(spark, p):
    rng = random.Random(2)
    rows = [(r[0], r[1]) for r in corpora.rows() if len(r[1] or "") < 3000][:70] + [(500 + k, corpora.prose(rng, 30).upper()) for k in range(20)]
    rows += [rows[0], rows[0], (None, "the of and"), (None, None), (600, ""), (601, None)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, chunk int, tokens string").repartition(4)
    order = lambda r: (r[0] is None, r[0] or 0, r[5])
    got = sorted((tuple(r)[:7] for r in score_documents(frame, p).collect()), key=order)
    want = sorted(plain(rows, p), key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert np.allclose([r[6] for r in got], [r[6] for r in want], rtol=1e-6)


def test_classes_beat_unigrams_on_held_out_documents(spark):
    rng = random.Random(7)
    kinds = [[f"{part}{k}" for k in range(150)] for part in ("noun", "verb", "mark")]
    rows = [(k, " ".join(rng.choice(kinds[j % 3]) for j in range(60))) for k in range(400)]
    got = score_documents(spark.createDataFrame(rows, "doc_id long, text string"), ClassModel(classes=6, core=300)).where("held_out").collect()
    assert len(got) > 30
    assert sum(r["score"] for r in got) > 0.85 * sum(r["base_score"] for r in got)
    assert all(r["perplexity"] == pytest.approx(10 ** (-r["score"] / r["n_tokens"])) for r in got)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    p = ClassModel(classes=4)
    counts = rng.integers(1, 30, 50)
    of_word = rng.integers(0, 3, 50)  # one class stays empty
    tokens = np.bincount(of_word, counts, 4).astype(np.int64)
    moves = rng.integers(0, 9, (5, 5))
    moves[:, 3] = 0
    model = Scorer(moves, tokens, np.bincount(of_word, minlength=4), 7, p)
    for before in range(6):
        words = sum(model.after[before, k] * max(c - p.discount, 0) / tokens[k] + model.rest[before] for k, c in zip(of_word, counts))
        end, unseen = model.after[before, 4] + model.rest[before], model.rest[before]
        assert words + end + unseen == pytest.approx(1)


def test_no_rows_and_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert score_documents(none).collect() == []
    got = score_documents(spark.createDataFrame([(None, "a b"), (None, "")], "doc_id long, text string")).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got) == [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]


def test_long_document_is_a_block_of_its_own(spark):
    text = "alpha beta " * 200_000
    got = score_documents(spark.createDataFrame([(1, text), (2, "alpha"), (3, "x" * 100_000)], "doc_id long, text string"), SMALL).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {1: 400_001, 2: 2, 3: 2}


@pytest.mark.parametrize("kind", [np.int32, np.uint64, np.uint8, np.int64])
def test_packed_arrays_come_back(kind):
    for size in (0, 1, 1000):
        values = np.random.default_rng(size).integers(0, 200, size).astype(kind)
        assert np.array_equal(_unpack(_pack(values), kind), values)
