"""The prefix trie, language identification and hard negatives against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from larkspur.llm import hard_negatives, language_id, prefix_trie
from larkspur.llm.queries import QUERIES

TURNS = "conv_id bigint, turn bigint, role string, text string"
VECTORS = "vec_id bigint, embedding array<float>, label int"
DOCS = "doc_id bigint, text string, lang string"


@pytest.mark.parametrize("name", ["op11_conversation_trie", "op13_hard_negatives"])
def test_against_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    problems, n = differences(QUERIES[name].run(spark, folder), connect(folder), QUERIES[name].oracle)
    assert not problems and n


# --- prefix trie ---------------------------------------------------------------


def trie_of(sequences: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    """Every node by walking along every sequence."""
    nodes: dict[tuple, list[int]] = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for key, members in nodes.items():
        under = [k for k in nodes if k[: len(key)] == key]
        children = [k for k in under if len(k) == len(key) + 1]
        leaves = sum(not any(len(j) == len(k) + 1 and j[: len(k)] == k for j in under) for k in under)
        saved = sum((len(nodes[k]) - 1) * len(k[-1][1].encode()) for k in under if k)
        ends = ",".join(map(str, sorted(c for c in members if len(sequences[c]) == len(key))))
        out.append((
            min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), len(children), leaves, saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    own: dict[int, list[tuple]] = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            # Equal turns go by the digest of both.
            body = f"{len(role.encode())}:{role}{len(text.encode())}:{text}".encode()
            own.setdefault(c, []).append((turn is not None, turn or 0, hashlib.sha256(body).digest(), role, text))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - int(math.fmod(c, 5)), [])[:h] + mine[h:]
    return out


def run_trie(spark, tmp_path, rows, schema=TURNS):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    found = QUERIES["op11_conversation_trie"].run(spark, str(tmp_path))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_trie_by_brute_force(spark, tmp_path):
    draw = random.Random(3)
    rows = [
        (c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "bé", "ccc"]))
        for c in range(60) for t in range(draw.randrange(1, 12))
    ]
    # Copies of one conversation; a long one; odd rows, ties and repeats.
    rows += [(c, t, "user", "same") for c in range(100, 140) for t in range(3)]
    rows += [(200, t, "user", str(t % 2)) for t in range(70)]
    rows += [(-7, 1, None, None), (-7, None, "user", "first"), (-5, 0, "user", ""), (-5, 0, "user", "tie"), (-5, 0, "user", "tie")]
    rows += [(None, 0, "user", "no conversation"), (201, None, "user", "x")]
    assert run_trie(spark, tmp_path, rows) == trie_of(rebuilt(rows))


def test_trie_without_rows(spark, tmp_path):
    assert run_trie(spark, tmp_path, []) == []
    assert run_trie(spark, tmp_path, [(None, 0, "user", "a")]) == []


def test_trie_of_turnless_conversations(spark, tmp_path):
    # Only turns that the rebuilt conversation does not keep: conversation 10 lends nothing to 11.
    rows = [(c, 0, "user", "x") for c in (11, 12, 13, 14)]
    assert run_trie(spark, tmp_path, rows) == trie_of(rebuilt(rows))


def test_trie_reads_its_columns_only(spark, tmp_path):
    rows = [(c, t, "user", f"{c % 3}{t}") for c in range(10) for t in range(4)]
    named = [(*r, 1, "x", 2, 3) for r in rows]
    found = run_trie(spark, tmp_path, named, TURNS + ", depth bigint, name string, node bigint, block bigint")
    assert found == trie_of(rebuilt(rows))


def test_members_of_a_node_are_hashed_in_pieces(spark):
    ends = spark.range(5000).selectExpr("2L as depth", "0L as node", "id as conv_id").repartition(7)
    (row,) = prefix_trie.hash_members(ends).collect()
    assert row["ends_sha256"] == hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest()


# --- language identification -----------------------------------------------------


def viterbi(scores: np.ndarray, penalty: float) -> float:
    """Best sum over all sequences, one text."""
    value = scores[0].copy()
    for s in scores[1:]:
        value = np.maximum(value, value.max() - penalty) + s
    return value.max()


def test_best_path_is_the_best_one():
    draw = np.random.default_rng(1)
    sizes = [1, 0, 5, 127, 128, 129, 700, 2, 0]
    first = np.cumsum([0, *sizes])
    scores = -draw.random((first[-1], 3)) * 6
    labels = language_id.best_path(scores, first, 2.0)
    for a, b in zip(first, first[1:]):
        if b > a:
            chosen = scores[np.arange(a, b), labels[a:b]].sum() - 2.0 * (labels[a + 1 : b] != labels[a : b - 1]).sum()
            assert chosen == pytest.approx(viterbi(scores[a:b], 2.0))


def test_words_are_runs_of_one_script():
    words = language_id.Spelled(pa.array(["Ab, cdж9é", None, "", "Ab"]))
    spelled = [(int(a), int(b)) for a, b in zip(words.start, words.end)]
    assert spelled == [(0, 2), (4, 6), (6, 7), (8, 9), (9, 11)]
    assert words.first.tolist() == [0, 4, 4, 4, 5]
    one, which = words.distinct()
    assert which[0] == which[4] and len(one) == 4


def test_held_out_languages(spark):
    found = QUERIES["op12_language_id"].run(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    hits = found.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert hits.first()[0] > 0.98
    assert found.count() == 1000 and not found.where("score < 0 or score > 1 or score is null").count()


def test_spans_of_mixed_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit_languages(docs)
    rows = docs.where("lang in ('en', 'de') and length(text) > 600").orderBy("doc_id").collect()
    en, de = (next(r["text"] for r in rows if r["lang"] == x)[:600] for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, f"{en}. {de}. {en}", None), (2, "Привет мир", None)], DOCS)
    one, two = language_id.label_languages(mixed, model).orderBy("doc_id").collect()
    assert [s["lang"] for s in one["spans"]] == ["en", "de", "en"]
    borders = [s["start"] for s in one["spans"][1:]]
    assert abs(borders[0] - 602) < 30 and abs(borders[1] - 1204) < 30
    assert one["lang_pred"] == "en" and 0.6 < one["score"] < 0.73
    assert two["lang_pred"] in model.langs


def test_script_narrows_candidates(spark):
    rows = [(i, "мама мыла раму вечером", "ru") for i in range(5)] + [(9 + i, "mama washed the window frame", "en") for i in range(5)]
    model = language_id.fit_languages(spark.createDataFrame(rows, DOCS))
    docs = spark.createDataFrame([(1, "вечером zzz qqq xxx вечером", None), (2, "qqqq", None)], DOCS)
    one, two = language_id.label_languages(docs, model, penalty=1.0).orderBy("doc_id").collect()
    assert [s["lang"] for s in one["spans"]] == ["ru", "en", "ru"] and two["lang_pred"] == "en"


def test_language_of_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !!", "de"), (None, "the cat and the dog", "en"), (None, "the cat and the dog", "en"),
            (4, "und der Hund", "de"), (5, "und der Hund", None), (6, "the word " * 40_000, "en")]
    docs = spark.createDataFrame([(*r, 0.5, 1) for r in rows], DOCS + ", score double, spans int")
    found = language_id.label_languages(docs, language_id.fit_languages(docs)).collect()
    by = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows)
    assert [by[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and by[1]["score"] == 0.0 and by[1]["spans"] == []
    assert by[4]["lang_pred"] == by[5]["lang_pred"] == "de" and by[6]["lang_pred"] == by[None]["lang_pred"] == "en"
    assert [tuple(s) for s in by[6]["spans"]] == [(0, 9 * 40_000 - 1, "en")]


def test_languages_without_anything_to_learn(spark):
    empty = spark.createDataFrame([], DOCS)
    model = language_id.fit_languages(empty)
    assert model.langs == [] and language_id.label_languages(empty, model).count() == 0
    docs = spark.createDataFrame([(1, "some text", None)], DOCS)
    assert language_id.label_languages(docs, model).first()["lang_pred"] == "und"


# --- hard negatives --------------------------------------------------------------


def mined(rows: list[tuple], every: int = 100) -> list[tuple]:
    """All pairs, in plain integers."""
    width = max((len(v) for _, v, _ in rows if v), default=0)
    good = []
    for vec_id, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(256 * float(np.float32(x))) for x in v]
            good.append((vec_id, q + [0] * (width - len(q)), label))
    out = []
    for k, (a, q, label) in enumerate(good):
        if a is None or a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, w)), i is None, i or 0, l) for j, (i, w, l) in enumerate(good) if j != k]
        scored.sort()
        for ps, pn, pid, _ in [s for s in scored if s[3] == label][:5]:
            fits = [s for s in scored if s[3] != label and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:10]
            out += [(a, None if pn else pid, r, None if n else i, -ps, -s) for r, (s, n, i, _) in enumerate(fits, 1)]
    return sorted(out, key=repr)


def run_mining(spark, rows, schema=VECTORS, **options):
    found = hard_negatives.mine_negatives(spark.createDataFrame(rows, schema), **options)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_negatives_by_brute_force(spark):
    draw = np.random.default_rng(5)
    middle = draw.normal(size=(4, 20))
    rows = [(i, (middle[i % 4] + draw.normal(size=20) * 0.7).tolist(), int((i + i // 9) % 4)) for i in range(400)]
    same = rows[17][1]
    rows += [(1000 + i, same, i % 2) for i in range(150)]  # one very common vector
    rows += [(2000, [0.0] * 20, 1), (2001, rows[3][1][:7], 2), (None, rows[4][1], 3), (None, rows[4][1], 0), (100, rows[8][1], 2)]
    rows += [(2100, None, 1), (2200, rows[0][1], None), (2300, [1.0, None], 1), (2400, [float("nan")] * 20, 1), (2500, [float("inf")], 0), (2600, [], 3)]
    assert run_mining(spark, rows) == mined(rows)


def test_negatives_in_many_groups(spark, monkeypatch):
    for name, value in (("CELL_ROWS", 40), ("CELL_ANCHORS", 7), ("_ROWS", 16), ("_ANCHORS", 3), ("_PAIRS", 50)):
        monkeypatch.setattr(hard_negatives, name, value)
    draw = np.random.default_rng(6)
    rows = [(i, draw.normal(size=33).tolist(), int(i % 3)) for i in range(200)]
    assert run_mining(spark, rows, is_anchor="vec_id % 10 = 0") == mined(rows, 10)


def test_bounds_leave_most_pairs_unscored(spark):
    """Vectors that lie in groups: few pairs are open after the summaries."""
    draw = np.random.default_rng(7)
    middle = np.repeat(draw.normal(size=(40, 16)), 4, axis=1) * 3
    vectors = [(i, (middle[i % 40] + draw.normal(size=64) * 0.1).astype(np.float32).tolist(), i % 40) for i in range(2000)]
    table = pa.Table.from_batches(
        list(hard_negatives._summaries(64)(iter([pa.RecordBatch.from_pydict({
            "vec_id": [v[0] for v in vectors], "label": pa.array([v[2] for v in vectors], pa.int32()),
            "embedding": pa.array([v[1] for v in vectors], pa.list_(pa.float32()))})])))
    ).append_column("row", pa.array(range(2000)))
    both = hard_negatives._Vectors.of(table)
    best = hard_negatives._Best(2000, 5)
    scored = hard_negatives._search(
        both, both, lambda i, j: np.ones((i.size, j.size), bool), lambda i, low, high: high >= best.floor[i],
        lambda i, j, s: best.add(i, s, both.ids[j], both.no_id[j]),
    )
    assert scored < 0.5 * 2000 * 2000


def test_negatives_of_large_components_and_empty_tables(spark):
    rows = [(i, [float(x) for x in v], l) for i, v, l in [(0, [30000, -2, 5], 0), (1, [29000, 1, 1], 0), (2, [15000, 9, 1], 1), (3, [20000, 0, 0], 1)]]
    assert run_mining(spark, rows) == mined(rows) != []
    assert run_mining(spark, []) == []
    assert run_mining(spark, [(1, [1.0], 1)]) == []
    huge = [(0, [3e38, 1.0], 0), (1, [3e38, 1.0], 0), (2, [2e5, 1.0], 1)]
    assert len(run_mining(spark, huge)) == 1


def test_negatives_read_their_columns_only(spark):
    rows = [(i, [float(i % 7), 1.0], i % 2) for i in range(30)]
    found = run_mining(spark, [(*r, 1, 2, "q") for r in rows], VECTORS + ", row bigint, rank int, q string")
    assert found == mined(rows)
