"""MinHash near-dedup, hard negatives and collocations against plain versions: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelson.llm import decontaminate, hard_negatives, minhash, phrases, queries
from keelson.llm.textbatch import Texts, bounds_of

from . import brute

SCHEMA = "doc_id long, text string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = ("key", "node", "bucket", "component", "set_id", "rows", "label", "near", "text_key", "name", "word", "n", "a", "w", "rank", "block", "pivot", "slice", "vector")


def plain_sets(rows):
    sets = []
    for _, t in rows:
        w = brute.WORD.findall((t or "").translate(UPPER))
        sets.append({tuple(w[i : i + 2]) for i in range(max(1, len(w) - 1))} if w else set())
    u, least = brute.Union(len(rows)), {}
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                u.join(i, j)
    for k, (i, _) in enumerate(rows):
        least[u.find(k)] = min(least.get(u.find(k), brute.LAST), brute.LAST if i is None else i)
    return brute.order((i, len(sets[k]), None if i is None else least[u.find(k)], i is None or i == least[u.find(k)]) for k, (i, _) in enumerate(rows))


def family(r, n, words, changed, start):
    """Texts that come from one another by some changed words each."""
    base, out = [f"w{r.randrange(4000)}" for _ in range(words)], []
    for k in range(n):
        text = list(base)
        for _ in range(r.randint(0, changed)):
            text[r.randrange(words)] = f"x{r.randrange(10**6)}"
        out.append((start + k, " ".join(text)))
    return out


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    rows = [x for k in range(6) for x in family(r, 25, 60 + 40 * k, 5 + 3 * k, 100 * k)]
    r.shuffle(rows)
    same = rows[3][1]
    return rows + [
        (900, None), (901, ""), (902, " \n"), (903, "One"), (904, "oNe"), (905, "one two"), (None, same), (None, None), (906, same.upper()), (5, same), (5, rows[9][1]),
        (907, "é " * 50), (908, "long " * 30000 + "text"), (909, "Long " * 40000 + "text"), (907, "É " * 50),
    ]


@pytest.mark.parametrize("group, tile, held", [(32, 1024, 1 << 18), (2, 4, 1 << 18), (3, 1024, 7)])
def test_near_sets(spark, monkeypatch, texts, group, tile, held):
    """Runs that are expanded, runs that are not, and runs that do not fit in what is held."""
    monkeypatch.setattr(minhash, "GROUP", group)
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "HELD", held)
    docs = spark.createDataFrame(texts, SCHEMA).repartition(5)
    assert brute.order(map(tuple, minhash.near_sets(docs).collect())) == plain_sets(texts)


def test_bridge_in_a_long_run(spark, monkeypatch):
    """Texts that are alike only through a third one are found where no run is expanded."""
    monkeypatch.setattr(minhash, "GROUP", 2)
    words = [f"w{k}" for k in range(200)]
    steps = [" ".join(f"y{k}" if k < 6 * s else w for k, w in enumerate(words)) for s in range(12)]
    rows = [(k, t) for k, t in enumerate(steps)] + [(50 + k, t + " end") for k, t in enumerate(steps)]
    assert {x[2] for x in plain_sets(rows)} == {0}
    assert brute.order(map(tuple, minhash.near_sets(spark.createDataFrame(rows, SCHEMA)).collect())) == plain_sets(rows)


def test_meeting_components_follow_from_first_nodes(spark, monkeypatch):
    """What meets in runs that are not expanded is found with some rows a text, not with a row for each of its tables; texts linked by others only are found."""
    r, rows, put = random.Random(6), {}, minhash.Workspace.put
    words = [f"w{k}" for k in range(200)]
    changed = lambda k, n: (k, " ".join(f"x{k}-{i}" if i in off else w for off in [set(r.sample(range(200), n))] for i, w in enumerate(words)))
    texts = [changed(k, 14) for k in range(300)] + [changed(k, 5) for k in range(300, 304)]  # only the last ones are alike

    def counted(self, df, name):
        out = put(self, df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(minhash.Workspace, "put", counted)
    assert brute.order(map(tuple, minhash.near_sets(spark.createDataFrame(texts, SCHEMA)).collect())) == plain_sets(texts)
    made = {name: n for name, n in rows.items() if name not in ("signed", "nodes", "found", "pairs", "near", "tiles")}
    assert rows["crowd"] == 304 and rows["tiles"] >= 1 and max(made.values()) <= minhash.TABLES // 4 * len(texts), rows


def test_runs_name_their_first_nodes(monkeypatch):
    """Each other node of a run that is not expanded comes with its first node, whether the two agree or not."""
    monkeypatch.setattr(minhash, "GROUP", 2)
    sign = lambda low: [low] * 4 + [~low & 0x7FFFFFFF]  # noqa: E731  the last one agrees with none
    columns = [[1] * 2 + [2] * 5 + [3], [1, 2, 1, 4, 5, 6, 7, 8], [5, 5, *sign(5), 5], [5, 5, *sign(5), 5]]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "node", "s1", "s2"])
    got = [tuple(x.values()) for b in minhash._runs(iter([batch])) for x in b.to_pylist()]
    assert sorted(got, key=str) == sorted(
        [(1, 1, None, True, False), (None, 1, 2, True, True), *((None, 1, x, True, x < 7) for x in (4, 5, 6, 7)), (3, 8, None, True, False)], key=str
    )


def test_keys_are_counted_in_their_task(monkeypatch):
    """A node has a key for each table; nodes that share keys and label are one row of a task, however many, unless it holds too many keys."""
    rows = np.arange(2 * minhash.HASHES, dtype=np.uint32).reshape(2, -1)
    batch = lambda nodes: pa.RecordBatch.from_arrays([pa.array([x for x, _ in nodes], pa.int64()), pa.array([rows[k].tobytes() for _, k in nodes])], names=["label", "rows"])
    batches = [batch([(7, 0), (7, 0), (8, 0)]), batch([]), batch([(7, 0), (7, 1)])]
    for held in (minhash.HELD, 1):
        monkeypatch.setattr(minhash, "HELD", held)
        found = [tuple(r.values()) for b in minhash._labels(iter(batches)) for r in b.to_pylist()]
        keys = [minhash.table_keys(rows[k : k + 1].T).ravel().view(np.int64).tolist() for k in (0, 1)]
        total = {}
        for key, label, n in found:
            total[key, label] = total.get((key, label), 0) + n
        assert total == {(k, 7): 3 for k in keys[0]} | {(k, 8): 1 for k in keys[0]} | {(k, 7): 1 for k in keys[1]}
        assert len(found) == (3 if held > 1 else 4) * minhash.TABLES


def test_recall_of_the_tables():
    """Pairs just above the threshold share a table, and pass the comparison of signatures, nearly always; pairs far below seldom do."""
    rng = np.random.default_rng(2)
    found = {}
    for shared in (80, 60, 20):  # of 100 in the union
        hits = 0
        for _ in range(400):
            union = rng.integers(0, 2**63, 500).astype(np.uint64)
            both, half = shared * 5, (100 - shared) * 5 // 2
            h = np.concatenate((union[: both + half], union[:both], union[both + half :]))
            rows = minhash.minhashes(h, bounds_of(np.array([both + half, 500 - half])))
            keys, (s1, s2) = minhash.table_keys(rows), minhash.signature(rows)
            hits += bool((keys[:, 0] == keys[:, 1]).any() and minhash.agreeing(s1[:1] ^ s1[1:], s2[:1] ^ s2[1:])[0] >= minhash.AGREE)
        found[shared] = hits / 400
    assert found[80] >= 0.99 and found[20] <= 0.01
    assert len(rows) == 26 and len(keys) == 78


def test_shingles_are_told_apart_by_128_bits():
    h, g = np.array([7, 7, 7, 9], np.uint64), np.array([1, 2, 1, 1], np.uint64)
    assert minhash._distinct(h, g, np.array([0, 3, 4]))[2].tolist() == [0, 2, 3]
    sets = minhash._sets(pa.array(["a b c", "a b", "", "c"]))
    assert [len(s) for s in sets] == [2, 1, 0, 1] and sets[1][0] in sets[0]
    off = minhash.shingles(Texts(np.frombuffer(b"A bA b", np.uint8), np.array([0, 3, 6])))[2]
    assert off.tolist() == [0, 1, 2]


# Phrases


def plain_phrases(rows, least=10, report=2000, absorbed=50):
    count, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            count.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    some = {p: a for p, a in count.items() if len(p[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in some.items():
        longer = [b for (x, q), b in some.items() if x == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= absorbed * a for b in longer):
            continue
        cuts = [(10**6 * a * a // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]]))
    return sorted((lang, r + 1, p.decode(), -a, l, right, totals[lang], -s) for lang, x in out.items() for r, (s, a, p, l, right) in enumerate(sorted(x)[:report]))


def spoken(seed=1):
    r = random.Random(seed)
    vocabulary = ["The", "of", "new", "york", "état", "a", "b"] + [f"v{k}" for k in range(25)]
    rows = []
    for _ in range(150):
        w = [r.choice(vocabulary) for _ in range(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            w.insert(r.randint(0, len(w)), r.choice(["New York City", "new york", "a a a a", "état civil,", "end.\nthe"]))
        rows.append((r.choice(["en", "en", "en", "fr", None, "und"]), r.choice([" ", " ", "\t", "  "]).join(w)))
    return rows + [("en", None), (None, ""), ("de", "ha " * 3000), ("de", "..;;\n"), ("xx", "once only")]


@pytest.mark.parametrize("occurrences, buckets", [(2_000_000, 4 << 20), (50, 1 << 10)])
def test_collocations(spark, monkeypatch, occurrences, buckets):
    monkeypatch.setattr(phrases, "OCCURRENCES", occurrences)
    monkeypatch.setattr(phrases, "BUCKET_BYTES", buckets)
    rows = spoken()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    want = plain_phrases(rows, 4)
    assert sorted(map(tuple, phrases.collocations(docs, 4).collect())) == want and len(want) > 30
    assert sorted(map(tuple, phrases.collocations(docs, report=5).collect())) == plain_phrases(rows, report=5)


def test_words_that_share_a_name_get_others(spark, monkeypatch):
    """Names that clash are noticed on all words, rare ones too, and dealt again."""
    given = phrases.range_hash
    monkeypatch.setattr(phrases, "range_hash", lambda buf, s, e, seed: given(buf, s, e, seed) % np.uint64(7 if seed == 0 else 2**63))
    rows = spoken(2)
    assert sorted(map(tuple, phrases.collocations(spark.createDataFrame(rows, "lang string, text string")).collect())) == plain_phrases(rows)


def test_scores_beyond_64_bits(spark):
    rows = spark.createDataFrame([(3 * 10**15, 3 * 10**15 + 1, 3 * 10**15 + 2)], "a long, l long, r long")
    got = rows.select(F.expr("(1000000BD * a * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) * r)").alias("s")).first().s
    assert got == 10**6 * (3 * 10**15) ** 2 // ((3 * 10**15 + 1) * (3 * 10**15 + 2))


# Hard negatives


def plain_negatives(rows, every=100):
    rows = sorted({(i, label, tuple(v)) for i, label, v in rows if None not in (i, label) and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    width = max([len(v) for *_, v in rows], default=0)
    known = []
    for i, label, v in rows:
        label = (label + 1) % 10 if i % 7 == 0 else label
        known.append((i, label, [int(np.floor(256 * x)) for x in v] + [0] * (width - len(v))))
    out = []
    for i, label, v in known:
        if i % every:
            continue
        score = sorted((-sum(x * y for x, y in zip(v, w)), j, other == label) for j, other, w in known if j != i)
        for s, j, _ in [x for x in score if x[2]][:5]:
            fits = [(-t, k) for t, k, same in score if not same and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(i, j, r + 1, k, -s, t) for r, (t, k) in enumerate(fits)]
    return sorted(out)


def vectors(n, seed=5, width=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width))
    return [(int(k), int(rng.integers(0, 10)), [float(x) for x in centres[rng.integers(5)] * 0.4 + rng.normal(size=width) * 0.2]) for k in range(n)]


@pytest.mark.parametrize("block, sample", [(1024, 8192), (16, 40)])
def test_hard_negatives(spark, monkeypatch, block, sample):
    for name, value in (("BLOCK", block), ("ANCHORS", 3), ("SLICE", 4), ("SALTED", 8), ("SAMPLE", sample)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(900)
    common = rows[200][2]
    rows += [(1000 + k, k % 3, common) for k in range(60)]  # ties
    rows += [(1100, None, common), (1200, 1, None), (1300, 1, [None, 1.0]), (1400, 1, [float("nan")]), (1500, 2, [float("inf")] * 16), (None, 1, common)]
    rows += [(1600, 3, [0.5]), (1700, 4, []), rows[0], rows[100], (300, 9, rows[7][2])]  # short, empty, repeated rows, an id with another vector
    docs = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(4)
    rows = [(i, label, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, label, v in rows]
    got = sorted(map(tuple, hard_negatives.hard_negatives(docs).collect()))
    assert got == plain_negatives(rows) and len(got) > 400


def test_searches_skip_what_cannot_reach(spark, monkeypatch):
    """Blocks of far-away keys are not asked for, and blocks that cannot reach the k-th score are not looked at."""
    rng = np.random.default_rng(1)
    rows = [(k, k % 2, [float(x) for x in np.eye(8)[k % 8] * 3 + rng.normal(size=8) * 0.01]) for k in range(2000)]
    monkeypatch.setattr(hard_negatives, "BLOCK", 32)
    looked = []
    space = hard_negatives.Space(np.floor(np.array([r[2] for r in rows]) * 256).astype(np.int32), int(max((np.floor(np.array(r[2]) * 256) ** 2).sum() for r in rows)))
    vectors_ = np.floor(np.array([r[2] for r in rows]) * 256).astype(np.int32)
    pivot, distance = space.keys(vectors_)
    order = np.lexsort((distance, pivot))
    q = vectors_[:1]
    ends = [np.full(1, v, np.int64).tobytes() for v in (np.iinfo(np.int64).min, np.iinfo(np.int64).max)]
    start = {"q_ids": np.array([0]).tobytes(), "q_labels": np.array([0], np.int32).tobytes(), "q_vectors": q.tobytes(), "lo": ends[0], "hi": ends[1], "least": None}
    search = hard_negatives._Search(start, 8, space, 5, True)
    given = hard_negatives._dot
    monkeypatch.setattr(hard_negatives, "_dot", lambda a, b: looked.append(len(b)) or given(a, b))
    blocks = []
    for p in np.unique(pivot):
        own = order[pivot[order] == p]
        for s in range(0, len(own), 32):
            part = own[s : s + 32]
            blocks.append({"pivot": p, "low": distance[part[0]], "high": distance[part[-1]], "ids": part.astype(np.int64).tobytes(), "labels": (part % 2).astype(np.int32).tobytes(), "vectors": vectors_[part].tobytes()})
    far = space.of_anchors(q)[0][0]
    for b in sorted(blocks, key=lambda b: max(b["low"] - far[b["pivot"]], far[b["pivot"]] - b["high"], 0)):
        search.see(b)
    score = given(q, vectors_)[0]
    want = sorted((-int(score[k]), k) for k in range(1, 2000) if k % 2 == 0)[:5]
    assert list(zip((-search.score[0, 0]).tolist(), search.id[0, 0].tolist())) == want
    assert sum(looked) < 1500


def test_scores_too_large_for_floats():
    a = np.array([[2**28 + 1, 3]], np.int32)
    assert hard_negatives._dot(a, a).tolist() == [[(2**28 + 1) ** 2 + 9]]


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert minhash.near_sets(empty).count() == 0 and phrases.collocations(empty).count() == 0
    none = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.hard_negatives(none).count() == 0
    assert hard_negatives.hard_negatives(spark.createDataFrame([(100, None, None), (200, 1, [None])], none.schema)).count() == 0
    rows = [(1, "a b c d", "en"), (2, "a b c d", None)]
    docs = spark.createDataFrame(rows, empty.schema).withColumns({c: F.lit("x") for c in CLASH})
    assert [tuple(r) for r in minhash.near_sets(docs).orderBy("doc_id").collect()] == [(1, 3, 1, True), (2, 3, 1, False)]
    assert phrases.collocations(docs, least=2).count() == 0
    got = spark.createDataFrame([(k, k % 3, [0.1 * k, 1.0]) for k in range(101)], none.schema)
    plain = sorted(map(tuple, hard_negatives.hard_negatives(got).collect()))
    assert sorted(map(tuple, hard_negatives.hard_negatives(got.withColumns({c: F.lit("x") for c in CLASH if c != "label"})).collect())) == plain


def test_repeated_words_against_repeated_words(monkeypatch):
    """Texts and items of one word, or of a few over and over, in bounded work; the result is that of every place looked at."""
    cases = [" ".join(["a"] * 60), " ".join(["a", "b"] * 30), " ".join(["a"] * 40 + ["b"] * 20), "a b c d e " * 10, "b " * 9 + "a " * 3]
    texts = ["a " * 110 + "b " * 25 + "c", "a b " * 50, "c a b " * 30 + "a " * 50, "a b c d e f g h i " * 12 + cases[0], "a " * 47]
    items = decontaminate.Items(list(range(len(cases))), cases)
    given = Texts(np.frombuffer("".join(texts).encode(), np.uint8), bounds_of(np.array([len(t) for t in texts])))
    got = decontaminate.matches(items, given)
    monkeypatch.setattr(decontaminate, "_again", lambda word, woff, text, low, high: np.zeros(len(low), bool))
    monkeypatch.setattr(decontaminate, "PROPOSED", 1 << 40)
    assert decontaminate.matches(items, given) == got
    assert {(t, i) for t, i, *_ in got} >= {(0, 0), (0, 2), (1, 1), (3, 0)} and (4, 0) not in {(t, i) for t, i, *_ in got}
    monkeypatch.undo()
    many = decontaminate.Items(list(range(100)), [" ".join(["x"] * (60 - k % 7) + ["y"] * (k % 7)) for k in range(100)])
    seen = []
    embedded = decontaminate.Items.embedded
    monkeypatch.setattr(decontaminate.Items, "embedded", lambda self, word, start, *rest: seen.append(len(start)) or embedded(self, word, start, *rest))
    long = Texts(np.frombuffer(b"x " * 3000, np.uint8), np.array([0, 6000]))
    assert len(decontaminate.matches(many, long)) == 100 and sum(seen) < 20_000


def test_registered():
    assert {"op11_minhash_near_dedup", "op12_hard_negatives", "op13_phrase_collocations"} <= set(queries.QUERIES) & set(queries.ORACLES)
