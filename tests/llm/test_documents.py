"""Duplicate finding, repeats, rules, packing and BPE against plain versions, with the awkward rows in the same table."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import corpora
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from winnower.llm import bpe, packing
from winnower.llm.exact_names import exact_dedup, normalised
from winnower.llm.near_dedup import NearDedup, near_dedup
from winnower.llm.packing import decompose, pack
from winnower.llm.quality_rules import COUNTS, Supervision, estimate, posterior, quality_rules
from winnower.llm.repeats import Repeats, covered, remove_repeats


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(corpora.rows(), corpora.DOCUMENTS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], corpora.DOCUMENTS)


def by_id(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["doc_id"]].append(r)
    return out


def test_near_duplicates_are_those_of_all_pairs(table):
    rows = table.collect()
    want = corpora.near_components([(r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None])
    got = near_dedup(table).collect()
    assert len(got) == len(rows)
    sets = {r["doc_id"]: len(corpora.shingle_set(r["text"])) for r in rows if r["doc_id"] is not None}
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["component_id"], r["n_shingles"], r["kept"]) == (want[r["doc_id"]], sets[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])


def test_large_buckets_are_compared_block_by_block(spark):
    import random

    rng = random.Random(2)
    base = corpora.prose(rng, 120)
    docs = [(k, corpora.near(rng, base, rng.choice([0.005, 0.02, 0.05]))) for k in range(90)]
    got = near_dedup(spark.createDataFrame(docs, "doc_id long, text string"), NearDedup(block_bytes=20_000)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == corpora.near_components(docs)


def test_block_names_find_equal_texts(table):
    rows = table.collect()
    got = exact_dedup(table, carry=["source"], block_bytes=64).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for r in rows:
        t = re.sub(r"[\x20\x09-\x0d]", "", r["text"] or "")
        groups[t].append((-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0, r["doc_id"]))
    want = {}
    for members in groups.values():
        for m in members:
            want.setdefault(m[3], set()).add((min(members)[3], len(members)))
    for r in got:
        assert (r["keep_id"], r["group_size"]) in want[r["doc_id"]]
    assert sum(r["kept"] for r in got) == len(groups)
    assert table.select(normalised(F.col("text")).alias("t")).where("t IS NULL").count() == 0


def test_repeats_match_all_windows(table):
    rows = table.collect()
    gone = corpora.repeated_bytes([r["text"] for r in rows])
    want = by_id([{"doc_id": r["doc_id"], "kept": bytes(b for b, g in zip((r["text"] or "").encode(), own, strict=True) if not g),
                   "n_removed": sum(own), "n_spans": sum(g and not (k and own[k - 1]) for k, g in enumerate(own))} for r, own in zip(rows, gone, strict=True)])
    for crowd, part in ((1024, 16), (1, 16), (0, 5)):
        got = by_id(remove_repeats(table, Repeats(crowd=crowd, part=part), carry=("source",)).collect())
        assert got.keys() == want.keys()
        for k in want:
            key = lambda r: (bytes(r["kept"]), r["n_removed"], r["n_spans"])
            assert sorted(map(key, got[k])) == sorted(map(key, want[k]))


def test_interval_tree_covers_what_repeats():
    rng = np.random.default_rng(3)
    for _ in range(80):
        slices = [bytes(rng.choice(np.frombuffer(b"ab", np.uint8), rng.integers(9, 60))) for _ in range(rng.integers(1, 6))]
        gone = corpora.repeated_bytes([s.decode() for s in slices], 9)
        for spans, own in zip(covered(slices, Repeats(length=9, gram=4)), gone, strict=True):
            assert [any(a <= k < b for a, b in spans) for k in range(len(own))] == own


def test_rule_counts_and_verdicts(table):
    rows = table.collect()
    got = by_id(quality_rules(table).collect())
    for r in rows:
        want = corpora.rule_counts(r["text"])
        assert any(tuple(g[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want for g in got[r["doc_id"]])
    for g in (x for xs in got.values() for x in xs):
        assert g["base_failed"] == (g["n_words"] < 50 or 100 * g["n_repeat_words"] > 50 * g["n_words"])
        assert not (g["kept"] and g["base_failed"])
    whole = quality_rules(table, carry=("doc_id", "text", "source")).select("doc_id", "text", "kept")
    assert whole.count() == len(rows)
    assert {(r["doc_id"], r["kept"]) for r in whole.collect()} == {(k, x["kept"]) for k, xs in got.items() for x in xs}


def test_votes_of_one_rule_suffice():
    # 900 documents that nobody objects to, 100 that one rule objects to, 3 with a stray vote of a rule that rarely speaks.
    patterns = np.array([[2, 2, 2, 2], [2, 0, 2, 2], [2, 2, 2, 0]])
    post = posterior(patterns, *estimate(patterns, np.array([900.0, 100.0, 3.0])))
    assert post[0] > 0.9 and post[1] < 0.1 and post[2] > 0.5


@pytest.mark.parametrize("shares", [(0.02, 0.08), (0.25, 0.08), (0.01, 0.01), (0.01, 0.3), (0.3, 0.3), (0.01, 0.01, 0.01), (0.01, 0.1, 0.3), (0.1, 0.1, 0.1), (0.3, 0.25, 0.3)])
@pytest.mark.parametrize("size", [1000, 10_000, 1_000_000])
def test_rules_that_speak_against_different_documents(shares, size):
    rules = len(shares)
    patterns = np.full((rules + 2, 8), 2)
    patterns[np.arange(rules), np.arange(rules) * 2] = 0
    patterns[rules, 5] = 1
    number = np.array([*(size * s for s in shares), 0.01 * size, size * (0.99 - sum(shares))])
    for first in range(rules):  # and with a few documents that two rules object to
        both = np.full((1, 8), 2)
        both[0, [2 * first, 2 * ((first + 1) % rules)]] = 0
        for extra in (0.0, 0.002 * size):
            post = posterior(np.concatenate((patterns, both)), *estimate(np.concatenate((patterns, both)), np.append(number, extra)))
            assert (post[:rules] < 0.5).all() and (post[rules:rules + 2] > 0.9).all() and post[-1] < 0.5


@pytest.mark.parametrize("size", [1000, 10_000, 1_000_000])
@pytest.mark.parametrize("rare", [1, 2, 3, 5, 100, 10_000])
def test_verdicts_do_not_depend_on_how_rare_a_pattern_is(size, rare):
    if rare > size // 10:
        return
    # Beside the rest and what one rule objects to, documents that one to eight rules object to.
    for single in (0.0, 0.02, 0.2):
        for others in (1, 2):
            patterns = np.full((10, 8), 2)
            for k in range(1, 9):
                patterns[k + 1, :k] = 0
                patterns[k + 1, k:] = others
            patterns[1, 7] = 0
            for k in range(1, 9):
                number = np.zeros(10)
                number[0], number[1], number[k + 1] = size * (1 - single) - rare, size * single, rare
                post = posterior(patterns, *estimate(patterns, number))
                assert post[0] == 1 and (np.diff(post[2:]) <= 1e-12).all()
                assert (post[3:] < 0.5).all()
                # What is rarer than false alarms stays, if the other rules vote for it.
                if rare <= 0.003 * size and k == 1 and others == 2:
                    assert post[2] > 0.5
                if rare >= 0.01 * size and k == 1:  # what is not, goes
                    assert post[2] < 0.5


def test_the_same_shares_give_the_same_verdicts():
    rng = np.random.default_rng(5)
    for _ in range(20):
        patterns = rng.choice(3, (12, 8), p=[0.15, 0.15, 0.7])
        number = rng.integers(1, 1000, 12).astype(float)
        one = posterior(patterns, *estimate(patterns, number))
        assert np.allclose(one, posterior(patterns, *estimate(patterns, number * 1000)))


def plain_posterior(documents: list[tuple[int, ...]], p: Supervision) -> list[float]:
    """The same estimation document by document: class 0 is good, the others are (rule, learned)."""
    size, rules = len(documents), len(documents[0])
    bad = [(k, learned) for learned in (True, False) for k in range(rules)]
    belief = []
    for votes in documents:
        objectors = [k for k, v in enumerate(votes) if v == 0]
        belief.append([0.05 if objectors else 1.0, *(0.95 / len(objectors) if learned and k in objectors else 0.0 for k, learned in bad)])

    def heard(c: int, j: int, vote: int) -> float:
        return sum(b[c] for b, v in zip(belief, documents, strict=True) if v[j] == vote) / size

    for _ in range(p.rounds):
        alarms = [(heard(0, j, 0) + p.false_alarms) / (heard(0, j, 0) + heard(0, j, 2) + 1) for j in range(rules)]
        share, accuse = [sum(b[0] for b in belief) / size + p.least], [alarms]
        for c, (k, learned) in enumerate(bad, 1):
            share.append(max(sum(b[c] for b in belief) / size - p.cost, 0.0) if learned else p.least)
            row = []
            for j in range(rules):
                if j == k:
                    row.append((heard(c, j, 0) + 1 - p.false_alarms) / (heard(c, j, 0) + heard(c, j, 2) + 1) if learned else 1 - p.false_alarms)
                else:
                    row.append(max((heard(c, j, 0) + p.others * p.weight) / (heard(c, j, 0) + heard(c, j, 2) + p.weight) if learned else p.others, alarms[j]))
            accuse.append(row)
        old, belief = belief, []
        for votes in documents:
            like = [s * np.prod([{0: a, 1: 1.0, 2: 1 - a}[v] for a, v in zip(row, votes, strict=True)]) for s, row in zip(share, accuse, strict=True)]
            belief.append([x / sum(like) for x in like] if 0 in votes else [1.0, *[0.0] * len(bad)])
        if max(abs(x - y) for a, b in zip(old, belief, strict=True) for x, y in zip(a, b, strict=True)) < 1e-9:
            break
    return [b[0] for b in belief]


def test_patterns_give_what_single_documents_give():
    rng = np.random.default_rng(6)
    for _ in range(4):
        documents = [tuple(map(int, rng.choice(3, 4, p=[0.1, 0.1, 0.8]))) for _ in range(60)]
        patterns, number = np.unique(np.array(documents), axis=0, return_counts=True)
        p = Supervision(rounds=60)
        post = {tuple(map(int, k)): v for k, v in zip(patterns, posterior(patterns, *estimate(patterns, number.astype(float), p)), strict=True)}
        assert np.allclose([post[d] for d in documents], plain_posterior(documents, p), atol=1e-6)


def test_shouted_and_repetitive_texts_leave_the_rest(spark):
    prose = [corpora.prose(random.Random(k), 80) for k in range(400)]
    texts = [*prose[:340], *(" ".join(f"{w} |" for w in t.split()) for t in prose[340:370]), *(t.upper() for t in prose[370:])]
    got = quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got if r["kept"]} == set(range(340))


def test_capitals_are_judged_where_letters_are_ascii(spark):
    rows = [(0, "длинный текст на кириллице ИБМ IBM " * 20), (1, "THE LONG TEXT IS SHOUTED " * 20), (2, "the “long” text is not — " * 20), (3, "汉字汉字汉字 USB " * 60), (4, "THE “LONG” — … TEXT 🙂🙂🙂🙂 " * 20)]
    got = quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["vote_capitals"] for r in got} == {0: 1, 1: 0, 2: 2, 3: 1, 4: 0}
    assert "n_other" not in got[0]


def test_packing_rebuilds_every_document(table):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = table.collect()
    got = pack(table).collect()
    assert len({r["sequence_id"] for r in got}) == len(got)
    pieces = by_id(got)
    for k, own in by_id(rows).items():
        if len(own) > 1 and k is None:
            continue
        ids = [*tokenizer.encode(own[0]["text"] or "", add_special_tokens=False).ids, 0]
        parts = sorted(pieces[k], key=lambda r: (r["start"], r["sequence_id"]))[::len(own)]
        assert b"".join(bytes(p["tokens"]) for p in parts) == np.array(ids, dtype="<u4").tobytes()
        assert all(p["length"] & (p["length"] - 1) == 0 and p["length"] <= 1024 and p["doc_tokens"] == len(ids) and p["offset"] == 0 for p in parts)
    buckets = sorted((r["sequence_id"], r["length"]) for r in got)
    assert [b for _, b in buckets] == sorted(b for _, b in buckets)
    assert decompose(2048 + 5, 1024) == [1024, 1024, 4, 1]
    assert zlib.crc32(np.array([0], dtype="<u4").tobytes()) in {r["c"] for r in pack(table).select(F.crc32("tokens").alias("c")).collect()}


def test_bpe_agrees_with_the_library(table):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in bpe.decode(bpe.encode(table, carry=("doc_id", "text"))).collect():
        want = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want, r["text"]
        assert r["decoded"] == tokenizer.decode(want, skip_special_tokens=False)


def test_word_table_starts_afresh():
    from winnower.llm.wordtable import WordTable

    table = WordTable(lambda words: (np.frombuffer("".join(words).encode(), np.uint8), np.array([len(w) for w in words])), limit=5)
    for _ in range(3):
        for texts in ([["ab", "c"], [], ["ab", "d", "e"]], [["f", "g", "h", "i", "j", "k", "ab"]], [["c", "x"]]):
            flat, bounds = table.ids(texts)
            assert [bytes(flat[a:b].astype(np.uint8)).decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == ["".join(t) for t in texts]


@pytest.mark.parametrize("work", [near_dedup, exact_dedup, remove_repeats, quality_rules, pack, bpe.encode])
def test_an_empty_table_gives_an_empty_one(empty, work):
    assert work(empty).count() == 0


def test_pattern_of_packing_is_the_librarys(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in (r[1] for r in corpora.rows() if r[1]):
        if "<|" not in text:
            words = packing.words(text)
            assert "".join(words) == text and words == packing.WORDS.findall(text)
            assert [i for w in words for i in tokenizer.encode(w, add_special_tokens=False).ids] == tokenizer.encode(text, add_special_tokens=False).ids


def test_the_faster_patterns_agree_on_all_of_latin():
    import random

    rng = random.Random(1)
    v = bpe.vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    for _ in range(400):
        text = "".join(rng.choice([chr(rng.randrange(256)), rng.choice("ab 1'sé \n")]) for _ in range(60))
        assert packing.LATIN_WORDS.findall(text) == packing.WORDS.findall(text)
        assert v.latin.findall(text) == v.words.findall(text)


def test_digests_follow_from_outputs(table):
    r = bpe.encode(table).where("size(ids) > 3").select("ids", F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("h")).first()
    assert r["h"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()
    assert len(COUNTS) == 10


def test_words_of_a_kind_that_sums_of_powers_cannot_tell_apart(spark):
    """Thue-Morse words and their complements have equal polynomials modulo 2**64 from some length on."""
    rows = []
    for k, power in enumerate((10, 11, 12)):
        bits = [bin(n).count("1") % 2 for n in range(1 << power)]
        rows += [(2 * k, "".join("ab"[b] for b in bits)), (2 * k + 1, "".join("ba"[b] for b in bits))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r["kept"] and r["n_shingles"] == 1 for r in near_dedup(frame).collect())
    lines = spark.createDataFrame([(0, "\n".join(t for _, t in rows)), (1, "\n".join([rows[0][1]] * 3))], "doc_id long, text string")
    assert {r["doc_id"]: r["n_dup_lines"] for r in quality_rules(lines).collect()} == {0: 0, 1: 2}
