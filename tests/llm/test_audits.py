"""The filter audit against filters that are applied one after the other."""

from __future__ import annotations

from itertools import permutations

import corpora
import pytest

from winnower.llm.filter_audit import audit


def fails(text: str | None) -> dict[str, bool]:
    text = text or ""
    words = corpora.WORD.findall(text)
    return {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
        "D": any(c in "#$%&*|" for c in text),
    }


def played(rows: list[tuple], labels: list[tuple]) -> dict[tuple, tuple]:
    least: dict[str, int] = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs: dict[str, list] = {}
    for i, text, lang in rows:
        known = fails(text) | {"E": i is not None and i > least[text or ""]}
        docs.setdefault(lang or "", []).append((known, i in good, i in toxic))
    out, shapley = {}, {}
    for part, own in docs.items():
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if d[0][letter]]
                left = [d for d in left if not d[0][letter]]
                all_fail = sum(d[0][letter] for d in own)
                unique = sum(d[0][letter] and sum(d[0].values()) == 1 for d in own)
                shapley[part, letter] = shapley.get((part, letter), 0) + len(gone)
                out[part, order, step] = (len(left), len(gone), all_fail - len(gone), unique, sum(d[1] for d in gone), sum(d[2] for d in gone))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(r[0], r[1], r[2]) for r in corpora.rows()]
    rows += [(900 + k, t, lang) for k, (t, lang) in enumerate([("SHOUTED WORDS " * 60, None), ("SHOUTED WORDS " * 60, ""), ("a | b " * 70, "de"), ("a | b " * 70, "en")])]
    rows += [(900, "SHOUTED WORDS " * 60, None), (None, "a | b " * 70, None), (None, "a | b " * 70, "de"), (3, "a | b " * 70, "de")]
    labels = [(k, k % 2, int(k % 5 == 0)) for k in range(0, 60)] + [(3, 0, 1), (3, None, None), (None, 1, 1), (901, 1, 1)]
    return rows, labels


def test_audit_equals_filters_in_turn(spark, tables):
    rows, labels = tables
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS part", "2 AS mask", "3 AS n")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS text")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in audit(docs, known).collect()}
    want = played(rows, labels)
    assert got == want
    assert len(got) == 600 * len({r[2] or "" for r in rows})


def test_audit_takes_other_filters(spark, tables):
    rows, labels = tables
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit(docs, known, {"x": "text = ''"}, "y").collect()
    assert {r["filter_order"] for r in got} == {"xy", "yx"}
    empty = sum(not r[1] for r in rows)
    assert sum(r["removed"] for r in got if (r["filter_order"], r["step"]) == ("xy", 1)) == empty


def test_audit_of_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []
