"""Each operator against a library, SQL or brute force, and on awkward rows."""

import base64
import hashlib
import os
import random
import re
import sys
from collections import defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import connect, differences  # noqa: E402

from larkspur.llm import (  # noqa: E402
    bpe, fingerprints, jaccard_join, line_rules, mixing, quality_model, suffix_dedup, token_counts, toxicity,
    url_filters,
)
from larkspur.llm.components import components  # noqa: E402
from larkspur.llm.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, `cluster` int, size string"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing column names."""
    random.seed(3)
    vocabulary = ["w%d" % i for i in range(900)]
    base = [random.choice(vocabulary) for _ in range(160)]
    near = list(base)
    near[80] = "changed"
    passage = [random.choice(vocabulary) for _ in range(60)]
    texts = [
        None, "", " \n\t", "one", "four words are here", " ".join(base), " ".join(base), " ".join(near),
        " ".join(passage), "before " + " ".join(passage) + " after it", "x" * 40_000,
        "\n".join("A line of the very long text, number %d." % i for i in range(3000)),
        "<|endoftext|> a  <|endoftext|> ünïcode 中文  \x1c end",
    ]
    rows = [(i, t, "en", "s%d" % (i % 3) if i % 4 else None, 1, "n", 1, "z") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[8], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.collect()]


def test_bpe_is_that_of_the_library(awkward):
    import tiktoken

    ranks = bpe.parse_ranks(open(RANKS, "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = sorted(
        (str(d), len(ids := library.encode_ordinary(t)), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        for d, t in texts_of(awkward)
    )
    found = bpe.round_trip(awkward, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in found) == expected
    encoded = bpe.encode_documents(awkward, RANKS, public_tokenizers.PATTERN)
    decoded = [(str(r.doc_id), bytes(r.decoded)) for r in bpe.decode_documents(encoded, RANKS).collect()]
    assert sorted(decoded) == sorted((str(d), t.encode()) for d, t in texts_of(awkward))


@pytest.mark.parametrize("seed", range(3))
def test_merge_replay_on_random_bytes(seed):
    merges = bpe.Merges(bpe.parse_ranks(open(RANKS, "rb").read()))
    random.seed(seed)
    words = [bytes(random.choice(b"aaabetrh \n\xc3\xa9") for _ in range(random.randint(1, 40))) for _ in range(400)]
    expected = [[merges.ranks[w]] if w in merges.ranks else merges.one(w) for w in words]
    assert merges.encode_words(words) == expected


def test_token_counts_are_those_of_the_library(awkward):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    expected = sorted(
        (str(d), len(t.encode()), n := len(library.encode(t, add_special_tokens=False)), n > 512) for d, t in texts_of(awkward)
    )
    found = token_counts.count_tokens(awkward, path).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in found) == expected


def brute_windows(rows):
    holders = defaultdict(set)
    for d, t in rows:
        w = WORD.findall(t)
        for s in range(len(w) - 49):
            holders[tuple(w[s : s + 50])].add(d)
    return holders


def test_suffix_dedup_against_brute_force(spark, awkward):
    rows = [(10**6 if d is None else d, t) for d, t in texts_of(awkward)]
    holders = brute_windows(rows)
    starts, repeats = defaultdict(set), defaultdict(set)
    for d, t in rows:
        w = WORD.findall(t)
        for s in range(len(w) - 49):
            own = holders[tuple(w[s : s + 50])]
            if len(own) > 1:
                starts[d].add(s)
                if min(own) != d:
                    repeats[d].add(s)
    found = suffix_dedup.repeated_passages(awkward).collect()
    assert {10**6 if r.doc_id is None else r.doc_id: set(r.starts) for r in found} == dict(starts)
    assert {r.doc_id: set(r.repeat_starts) for r in found if r.doc_id is not None and r.repeat_starts} == {
        d: s for d, s in repeats.items() if d < 10**6
    }
    left = suffix_dedup.drop_repeats(awkward.where("doc_id in (8, 9)"))
    assert left.schema == awkward.schema
    assert {r.doc_id: r.text for r in left.collect()}[9].split() == ["before", "after", "it"]


def test_passages_cut_from_each_other(spark):
    """Pieces of 30 to 90 words from one source: texts that go far to the right with one
    partner and far to the left with another one, over many parts of few rows."""
    random.seed(11)
    source = ["q%d" % random.randrange(10**6) for _ in range(400)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(random.randint(1, 5)):
            at, size = random.randrange(330), random.randint(30, 90)
            words += source[at : at + size] + ["o%d" % random.randrange(10**6) for _ in range(random.randint(0, 3))]
        rows.append((i, " ".join(words)))
    rows += [(150, rows[3][1]), (151, " ".join([*source[:60], *source[:60]]))]
    holders = brute_windows(rows)
    expected = {}
    for d, t in rows:
        w = WORD.findall(t)
        shared = {s for s in range(len(w) - 49) if len(holders[tuple(w[s : s + 50])]) > 1}
        if shared:
            expected[d] = shared
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for parts in ("1", "40"):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            found = {r.doc_id: set(r.starts) for r in suffix_dedup.repeated_passages(docs).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert found == expected


def test_neighbours_in_order_have_the_most_in_common():
    """Blocks in common with the nearest other text, against all pairs, in batches of three rows."""
    random.seed(2)
    shift = suffix_dedup.BITS
    rows = sorted({
        (random.randrange(4), sum(random.randrange(3) << (shift * b) for b in range(3)), random.randrange(9), random.randrange(3))
        for _ in range(120)
    })
    names = ["head", "right", "uid", "pos"]
    repeated = [r for r in rows for _ in range(random.randint(1, 3))]
    batches = [
        pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in repeated[i : i + 3]]) for i in range(0, len(repeated), 3)
    ]
    found = {}
    for batch in suffix_dedup._compared("right", names, "ahead")(iter(batches)):
        for r in batch.to_pylist():
            found[(r["head"], r["uid"], r["pos"], r["ahead"])] = found.get((r["head"], r["uid"], r["pos"], r["ahead"]), 0) + 1

    def alike(a, b):
        if a[0] != b[0]:
            return -1
        codes = [[(x[1] >> (shift * b)) % (1 << shift) for b in (2, 1, 0)] for x in (a, b)]
        return next((k for k in range(3) if codes[0][k] != codes[1][k]), 3)

    inner = list(rows)
    while inner and inner[0][2] == rows[0][2]:
        inner.pop(0)
    while inner and inner[-1][2] == rows[-1][2]:
        inner.pop()
    expected = defaultdict(int)
    for r in rows:
        best = max(alike(r, o) for o in rows if o[2] != r[2])
        if r not in inner:
            best = 3  # the neighbour may be in another part
        if best >= 0:
            expected[(r[0], r[2], r[3], best)] += 1
    assert found == dict(expected)


def test_similarity_join_against_brute_force(spark, awkward):
    rows = texts_of(awkward)
    found = {str(r.doc_id): r for r in jaccard_join.join_similar(awkward).collect()}
    assert found["5"].class_id == found["6"].class_id == found["7"].class_id == 5
    assert found["5"].n_copies == 4 and found["5"].n_links == found["7"].n_links == 1
    assert found["9"].n_links == 1 and found["9"].class_id == 8 and found["3"].n_links == 0
    assert found["1"].class_id == 0 and len(rows) == sum(1 for _ in jaccard_join.join_similar(awkward).collect())
    kept = jaccard_join.keep_first(awkward)
    assert kept.schema == awkward.schema
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4, 5, 8, 10, 11, 12]


def test_repeated_passages_do_not_part_near_copies(spark):
    """A text and the same text two or six times over: like sets, unlike numbers of shingles."""
    random.seed(4)
    rows = []
    for i, times in enumerate((1, 2, 1, 6, 3)):
        if times != 2 and times != 6:
            own = " ".join("r%d" % random.randrange(10**6) for _ in range(100))
        rows.append((i, " ".join([own] * times)))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    near = [[j for j, b in enumerate(sets) if 5 * len(a & b) >= 4 * len(a | b)] for a in sets]
    assert near == [[0, 1], [0, 1], [2, 3], [2, 3], [4]]
    found = sorted(jaccard_join.join_similar(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert [r.n_links for r in found] == [len(own) - 1 for own in near]
    assert [r.class_id for r in found] == [min(own) for own in near]


def test_many_near_copies_are_one_class(spark):
    random.seed(1)
    base = ["v%d" % random.randrange(5000) for _ in range(120)]
    rows = []
    for i in range(300):
        own = list(base)
        for _ in range(random.randint(0, 3)):
            own[random.randrange(120)] = "e%d" % random.randrange(10**6)
        rows.append((i, " ".join(own)))
    sets = [{tuple(w[i : i + 5]) for i in range(116)} for w in (t.split() for _, t in rows)]
    near = [[j for j, b in enumerate(sets) if 5 * len(a & b) >= 4 * len(a | b)] for a in sets]
    expected = [len({rows[j][1] for j in own} - {rows[i][1]}) for i, own in enumerate(near)]
    found = sorted(jaccard_join.join_similar(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert [r.n_links for r in found] == expected
    label = list(range(300))
    for _ in range(8):  # least label among linked and equal texts, until it settles
        label = [min(label[j] for j in own) for own in near]
    assert [r.class_id for r in found] == label


def test_fingerprints_against_sets(awkward):
    docs = awkward.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = sorted(texts_of(docs))
    paragraph = re.compile(fingerprints.PARAGRAPH)
    found = {r.doc_id: r for r in fingerprints.fingerprint_versions(docs).collect()}
    for (d, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + following[:cut]
        a, e, n = (set(paragraph.findall(x)) for x in (t, edited, following))
        assert found[d].n_chars == len(t)
        assert found[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert found[d].near_edited == pytest.approx(len(a & e) / len(a | e) if a | e else 1)
        assert found[d].near_next == pytest.approx(len(a & n) / len(a | n) if a | n else 1)
    assert found[5].fingerprint == found[6].fingerprint != found[7].fingerprint
    assert fingerprints.fingerprint_versions(awkward).count() == awkward.count()


def peeled(one, other):
    """Digests in which two fingerprints differ, from their text alone; None if stuck."""
    sketch = []
    for shown in (one, other):
        raw = base64.b64decode(shown)
        cells = [(int.from_bytes(raw[i : i + 2]), int.from_bytes(raw[i + 2 : i + 10]), int.from_bytes(raw[i + 10 : i + 14]))
                 for i in range(0, len(raw), 14)]
        sketch.append(cells)
    third = min(len(s) for s in sketch) // 3
    total = [[0, 0, 0] for _ in range(3 * third)]
    for sign, cells in zip((1, -1), sketch):
        wide = len(cells) // 3
        for c, (n, k, x) in enumerate(cells):
            cell = total[c // wide * third + c % wide % third]
            cell[0] += sign * n
            cell[1] ^= k
            cell[2] ^= x

    def chain(k, *more):
        found = xxhash.xxh64_intdigest(k.to_bytes(8, "little"), seed=42)
        for m in more:
            found = xxhash.xxh64_intdigest(m.to_bytes(4, "little"), seed=found)
        return found

    def place(h):
        return (h - (1 << 64) if h >> 63 else h) % third

    found, going = 0, True
    while going:
        going = False
        for n, k, x in total:
            if abs(n) == 1 and x == chain(k, 99) & 0xFFFFFFFF:
                for t in range(3):
                    cell = total[t * third + place(chain(k, t, 0))]
                    cell[0] -= n
                    cell[1] ^= k
                    cell[2] ^= x
                found, going = found + 1, True
                break
    return None if any(map(any, total)) else found


def test_fingerprints_peel_from_their_text(spark):
    """Likeness follows from the two returned fingerprints, of whatever sizes."""
    random.seed(8)
    texts, lines = [], ["Line %d of the page has its own text." % i for i in range(40)]
    for i in range(60):
        lines[random.randrange(len(lines))] = "Line %d came later." % (1000 + i)
        lines += ["Line %d was added at the end." % (2000 + i)] * (i % 2)
        texts.append("\n".join(lines))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = sorted(fingerprints.fingerprint_versions(docs).collect())
    paragraph = re.compile(fingerprints.PARAGRAPH)
    sets = [set(paragraph.findall(t)) for t in texts]
    sizes, settled = {len(r.fingerprint) for r in found}, 0
    for i, (row, following) in enumerate(zip(found, found[1:] + found[:1])):
        a, n = sets[i], sets[(i + 1) % 60]
        assert row.near_next == pytest.approx(len(a & n) / len(a | n))
        delta = peeled(row.fingerprint, following.fingerprint)
        if delta is not None:
            settled += 1
            assert delta == len(a ^ n)
        delta = peeled(row.fingerprint, row.edited_fingerprint)
        cut = len(texts[i]) // 4
        e = set(paragraph.findall(texts[i][: len(texts[i]) - cut] + texts[(i + 1) % 60][:cut]))
        assert row.near_edited == pytest.approx(len(a & e) / len(a | e))
        assert delta is None or delta == len(a ^ e)
    assert settled >= 55 and len(sizes) > 1


def test_fingerprints_of_ids_that_own_ranges(spark):
    """A third of the ids null, a third the same one: the order holds across their ranges."""
    ids = [None] * 40 + [7] * 40 + list(range(-20, 20))
    rows = [(d, "".join("Text %d says this in line %d.\n" % (i, j) for j in range(6))) for i, d in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    hashed = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    least = -(1 << 63)
    order = sorted(rows, key=lambda r: (least if r[0] is None else r[0], hashed[r[1]]))
    expected = sorted(
        (least if d is None else d, hashlib.sha256((t[: len(t) - len(t) // 4] + n[: len(t) // 4]).encode()).hexdigest())
        for (d, t), (_, n) in zip(order, order[1:] + order[:1])
    )
    found = fingerprints.fingerprint_versions(docs).collect()
    assert sorted((least if r.doc_id is None else r.doc_id, r.edited_sha256) for r in found) == expected


def test_line_rules(awkward, spark):
    found = {str(r.doc_id): r for r in line_rules.clean_lines(awkward).collect()}
    assert found["0"].n_words == 0 and found["0"].base_failed and not found["2"].kept
    assert found["11"].n_words == 27000 and found["11"].kept is not None
    text = "\n".join(" ".join("word%d" % (9 * i + j) for j in range(9)) + "." for i in range(9))
    row = line_rules.clean_lines(spark.createDataFrame([(1, text + "\nHome | News | About | Help")], "doc_id bigint, text string")).first()
    assert row.kept and row.clean_text == text


def test_mixing(awkward):
    found = mixing.mix_sources(awkward).collect()
    assert len(found) == awkward.count()
    assert all(0 <= r.taken <= 3 * r.size for r in found)
    taken = mixing.take_mix(awkward)
    assert taken.schema == awkward.schema
    assert taken.count() == sum(r.taken // r.size for r in found if r.size)


def test_targets_of_many_sources(spark, monkeypatch):
    """Shares, stops and reshared excess against a plain loop, in groups of buckets or not."""
    random.seed(4)
    sizes = {"s%03d" % i: random.choice([0, 1, 5, 40, 1000, 90000]) for i in range(200)} | {None: 77}
    names = sorted((s for s in sizes if s), key=lambda s: s.encode()) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    goal, stopped = {}, set()
    while True:
        level = (sum(sizes.values()) - 3 * sum(sizes[s] for s in stopped)) / sum(weight[s] for s in names if s not in stopped)
        more = {s for s in names if 3 * sizes[s] < level * weight[s]}
        if more == stopped:
            break
        stopped = more
    goal = {s: min(3 * sizes[s], level * weight[s]) for s in names}
    assert 0 < len(stopped) < len(names)
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint").repartition(5)
    assert {r.source: r.target for r in mixing.targets(df).collect()} == pytest.approx(goal)

    docs = spark.createDataFrame(
        [(i, "s%d" % (i % 3 if i % 2 else 0), "word " * (i % 17)) for i in range(400)], "doc_id bigint, source string, text string"
    )
    whole = sorted(mixing.mix_sources(docs).collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    monkeypatch.setattr(mixing, "GROUP", 3)
    assert sorted(mixing.mix_sources(docs).collect()) == whole


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 60)] + [(7, 7), (None, 3)]
    found = components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()
    assert {r.label for r in found if r.id < 50} == {0} and {r.label for r in found if r.id >= 100} == {100}


def test_url_aliases(spark):
    rows = [
        (1, "https://a.net/es/x", '<link rel="canonical" href="http://b.org/page">'),
        (2, "http://b.org/page/?utm_source=z#top", "<p>"),
        (3, "http://c.org/q", '<meta http-equiv="refresh" content="0; url=http://b.org/page">'),
        (4, "http://d.com/", '<link rel=canonical href="http://c.org/e">'), (5, "http://c.org/e", None),
        (6, None, None), (7, "no scheme", ""), (1, "https://a.net/es/x", None), (8, "HTTP://WWW.Example.COM/en/1?x", ""),
    ]
    found = {r.page_id: r for r in url_filters.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [found[i].verdict for i in range(1, 9)] == ["block", "block", "block", "allow", "allow", "allow", "allow", "allow"]
    assert found[8].rule == "www.example.com/en/" and found[8].host == "www.example.com" and found[6].host == ""


def test_relative_url_aliases(spark):
    rows = [
        (1, "http://x.net/es/a.html", '<meta http-equiv=refresh content="0; url=../en/b.html">'),
        (2, "http://x.net/en/b.html", '<link rel=canonical href="?p=2&amp;q=3">'), (3, "http://x.net/en/b.html?p=2&q=3", None),
        (4, "http://y.org/d/c.html", '<link rel="canonical" href="e.html"><link rel="canonical" href="http://x.net/es/z">'),
        (5, "http://y.org/d/e.html", ""),
        (6, "http://y.org/f", '<base href="http://y.org/d/g/"><meta http-equiv="refresh" content="0;url=.././e.html#x">'),
        (7, "http://y.org", '<link rel="canonical" href="d/c.html">'),
        (8, "http://y.org/m", '<link rel="canonical" href="mailto:d/e.html"><link rel=canonical href=#top>'),
        (9, "http://y.org/mailto:d/e.html", '<link rel="canonical" href="http://x.net/es/z">'), (10, "http://x.net/es/z", None),
    ]
    found = {r.page_id: r.verdict for r in url_filters.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [found[i] for i in range(1, 11)] == ["block"] * 7 + ["allow", "block", "block"]


def test_classifiers(spark, awkward):
    random.seed(2)
    plain = ["river", "stone", "garden", "window", "morning", "paper", "silver", "number"]
    rows, marks = [], []
    for i in range(600):
        words = [random.choice(plain) for _ in range(60)]
        if i % 3 == 0:
            words = [w + "%%%" for w in words]
        if i % 4 == 0:
            words[10:12] = ["vexoid" + random.choice("abcdefg"), "vexoid" + random.choice("hijk")]
        words[20] = random.choice(["women", "men"]) if i % 4 else "women"
        rows.append((i, " ".join(words) + "."))
        marks.append((i, int(i % 3 != 0), int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    model = quality_model.fit_quality(docs, labels.selectExpr("doc_id", "quality label"))
    scored = quality_model.score_quality(docs, model).join(labels, "doc_id")
    assert scored.where("predicted = quality").count() >= 595
    toxic = toxicity.fit_toxicity(docs, labels.selectExpr("doc_id", "toxic label"))
    scored = toxicity.score_toxicity(docs, toxic).join(labels, "doc_id")
    assert scored.where("predicted = toxic").count() >= 595
    score = toxic.scorer()
    assert abs(score("The women in the garden.") - score("The men in the garden.")) < 0.05
    for scorer, m in ((quality_model.score_quality, model), (toxicity.score_toxicity, toxic)):
        odd = scorer(awkward, m).collect()
        assert len(odd) == awkward.count() and all(0 <= r.score <= 1 for r in odd)
    none = labels.selectExpr("doc_id", "quality label").limit(0)
    assert quality_model.score_quality(docs.limit(1), quality_model.fit_quality(docs, none)).first().score == 0.5
    assert toxicity.fit_toxicity(docs, none).weights == {}


def test_toxicity_ranks_where_only_label_0_has_words_of_its_own(spark):
    random.seed(4)
    plain = ["river", "stone", "garden", "window", "morning", "paper", "silver", "number"]
    rows = [(i, " ".join(random.choices(plain, k=30)) + (" vexoid" if i % 5 == 0 else ""), int(i % 5 != 0)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    model = toxicity.fit_toxicity(docs.select("doc_id", "text"), docs.where("doc_id < 300").select("doc_id", "label"))
    held = toxicity.score_toxicity(docs.select("doc_id", "text").where("doc_id >= 300"), model).join(docs, "doc_id")
    low, high = held.agg(F.min(F.when(F.col("label") == 1, F.col("score"))), F.max(F.when(F.col("label") == 0, F.col("score")))).first()
    assert low > high


EMPTY = {
    "bpe": lambda d: bpe.round_trip(d, RANKS, public_tokenizers.PATTERN),
    "counts": lambda d: token_counts.count_tokens(d, public_tokenizers.path("byte_bpe_50k.json")),
    "suffix": suffix_dedup.repeated_passages, "drop": suffix_dedup.drop_repeats, "join": jaccard_join.join_similar,
    "first": jaccard_join.keep_first, "prints": fingerprints.fingerprint_versions, "lines": line_rules.clean_lines,
    "mix": mixing.mix_sources, "take": mixing.take_mix,
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty_table(awkward, name):
    assert EMPTY[name](awkward.where(F.lit(False))).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.oracle])
def test_queries_with_sql(spark, name):
    assert not differences(QUERIES[name].run(spark, FOLDER), connect(FOLDER), QUERIES[name].oracle)[0]


def test_only_the_passage_and_emptied_lines_go(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [
        (1, passage), (2, f"x\n\ny\n \n{passage}\n\x85\nz"), (3, f"{passage}\n\nend"),
        (4, f"a {passage} b\n\n"), (5, f" {passage}\n"), (6, f"top\n{passage}"),
    ]
    left = suffix_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.doc_id: r.text for r in left.collect()} == {
        1: passage, 2: "x\n\ny\n \n\x85\nz", 3: "\nend", 4: "a  b\n\n", 6: "top",
    }


def test_clashing_columns_stay(spark):
    passage = " ".join(f"p{i}." for i in range(60))
    names = ["_uid", "uid", "_cuts", "cuts", "_of", "of", "_id", "id", "row", "_row", "_order", "_times"]
    lines = ["_text", "_words", "_lines", "_each", "_hashes", "_windows", "_same", "_good"]
    columns = ["doc_id", "text", *names, *lines]
    rows = [(d, text, *range(len(columns) - 2)) for d, text in ((1, passage), (2, passage + " more words"), (3, passage))]
    docs = spark.createDataFrame(rows, columns)
    left = suffix_dedup.drop_repeats(docs)
    assert left.columns == columns and {r["text"].strip() for r in left.collect()} == {passage, "more words"}
    first = jaccard_join.keep_first(docs)
    assert first.columns == columns and [r["doc_id"] for r in first.collect()] == [1]
    judged = line_rules.clean_lines(docs)
    assert judged.columns[: len(columns)] == columns and judged.count() == 3
    assert all(tuple(r[c] for c in columns[2:]) == tuple(range(len(columns) - 2)) for r in judged.collect())


def test_ids_that_are_texts(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([("a", passage), ("b", passage + " x"), ("7", "other " + passage)], "doc_id string, text string")
    assert suffix_dedup.repeated_passages(docs).count() == 3
    assert suffix_dedup.drop_repeats(docs).count() >= 1
    assert fingerprints.fingerprint_versions(docs).count() == 3


def test_the_same_row_of_a_repeated_id_stays(spark):
    text = "one text of several words that is there more than once"
    rows = [(1, text, f"s{i}") for i in range(9)]
    kept = {
        jaccard_join.keep_first(spark.createDataFrame(r, "doc_id bigint, text string, source string")).first()["source"]
        for r in (rows, rows[::-1], rows[4:] + rows[:4])
    }
    assert len(kept) == 1


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    marks = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    held = QUERIES["op1_quality_classifier"].run(spark, folder).where("held_out").join(marks, "doc_id")
    right, n = held.agg(F.count_if(F.col("predicted") == F.col("quality")), F.count("*")).first()
    assert n > 100 and right >= 0.98 * n


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    marks = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    held = QUERIES["op8_toxicity"].run(spark, folder).where("held_out").join(marks, "doc_id")
    counts = {(r["toxic"], r["predicted"]): r["count"] for r in held.groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] >= 0.8 * (counts[1, 1] + counts.get((1, 0), 0))
    assert counts.get((0, 1), 0) <= 0.01 * counts[0, 0]


def brute_classes(texts):
    """Least id of each component of links at 0.8, by all pairs that share a shingle."""
    sets = {}
    for d, t in texts.items():
        w = WORD.findall(t)
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    label = {d: d for d in texts}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    holders = defaultdict(set)
    for d, s in sets.items():
        for x in s or {("text", texts[d])}:
            holders[x].add(d)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    for a, b in pairs:
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if texts[a] == texts[b] or 5 * both >= 4 * either > 0:
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return {d: root(d) for d in texts}


def brute_cuts(texts):
    holders = brute_windows(texts.items())
    out = {}
    for d, t in texts.items():
        found = list(WORD.finditer(t))
        words = [m.group() for m in found]
        gone = [False] * len(words)
        for s in range(len(words) - 49):
            if min(holders[tuple(words[s : s + 50])]) != d:
                gone[s : s + 50] = [True] * 50
        if not any(gone):
            out[d] = t
            continue
        # Runs that overlap or touch are cut as one.
        pieces, at, i = [], 0, 0
        while i < len(words):
            if gone[i]:
                j = i
                while j + 1 < len(words) and gone[j + 1]:
                    j += 1
                pieces.append(t[at : found[i].start()])
                at, i = found[j].end(), j
            i += 1
        marked = "\0".join([*pieces, t[at:]])
        lines = [x for x in marked.split("\n") if "\0" not in x or WORD.search(x.replace("\0", ""))]
        left = "\n".join(lines).replace("\0", "")
        if WORD.search(left):
            out[d] = left
    return out


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_pipeline_stage_by_stage(spark, tmp_path):
    """All rows of every stage after the classifier, by brute force, SQL and the public tokenizer."""
    import corpus_pipeline
    import duckdb
    import tiktoken
    from larkspur.llm.queries import _OP5_SQL
    from tiktoken.load import load_tiktoken_bpe

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scored = {r.doc_id: r.predicted for r in QUERIES["op1_quality_classifier"].run(spark, FOLDER).collect()}
    good = corpus_pipeline.good_documents(spark, docs, FOLDER)
    assert good.schema == docs.schema
    rows = {r.doc_id: r for r in good.collect()}
    assert set(rows) == {d for d, p in scored.items() if p == 1} and len(rows) > 100

    texts = {d: r.text for d, r in rows.items()}
    classes = brute_classes(texts)
    first = corpus_pipeline.one_of_each_class(spark, good, FOLDER)
    kept = sorted(r.doc_id for r in first.collect())
    assert first.schema == docs.schema and kept == sorted({c for c in classes.values()})

    cut = corpus_pipeline.without_repeats(spark, first, FOLDER)
    found = {r.doc_id: r for r in cut.collect()}
    expected = brute_cuts({d: texts[d] for d in kept})
    assert cut.schema == docs.schema and {d: r.text for d, r in found.items()} == expected
    assert all(r.n_chars == len(r.text) and r.source == rows[d].source for d, r in found.items())

    con = duckdb.connect()
    frame = cut.toPandas()
    con.register("documents", frame)
    times = {d: t // s if s else 0 for d, s, t in con.execute(f"SELECT doc_id, size, taken FROM ({_OP5_SQL})").fetchall()}
    mix = corpus_pipeline.mixed(spark, cut, FOLDER)
    taken = defaultdict(int)
    for r in mix.collect():
        taken[r.doc_id] += 1
        assert r.text == expected[r.doc_id]
    assert mix.schema == docs.schema and dict(taken) == {d: n for d, n in times.items() if n}

    library = tiktoken.Encoding(
        "ours", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(RANKS), special_tokens={}
    )
    encoded = sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert encoded == sorted((d, len(library.encode_ordinary(expected[d]))) for d, n in taken.items() for _ in range(n))
