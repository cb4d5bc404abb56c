"""Each operator against a brute-force version, an exact round trip or held-out data."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checking import compare, connect
from kinfold.llm import cover, exact, gru, lines, lm, minhash, mixing, pieces, queries, suffix, toxic, warc
from kinfold.llm.common import stored

SF = "/root/testdata/sf0.001"


def documents(spark, texts, **columns):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def components(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("name", [k for k, (_, sql) in queries.QUERIES.items() if sql])
def test_query_matches_its_sql(spark, name):
    fn, sql = queries.QUERIES[name]
    compare(fn(spark, SF), connect(SF), sql)


# --- near duplicates ------------------------------------------------------------------

def near_texts(rng, families, size, edits):
    out = []
    for _ in range(families):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(30, 120))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(edits + 1)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(copy))
    rng.shuffle(out)
    return out


def near_brute(texts, percent):
    sets = []
    for t in texts:
        w = t.encode().lower().split()
        k = min(5, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return [len(s) for s in sets], components(len(sets), pairs)


@pytest.mark.parametrize("chunk", [1024, 8])
def test_near_duplicates(spark, monkeypatch, chunk):
    """Small chunks send the families through hubs and the pass over what is left."""
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    monkeypatch.setattr(minhash, "REST_CHUNK", max(2, chunk // 4))
    texts = near_texts(random.Random(5), 12, 25, 3) + ["A b C", "a B c", "", "one two three four five"]
    sizes, roots = near_brute(texts, 85)
    out = {r.doc_id: r for r in minhash.near_dedup(documents(spark, texts)).collect()}
    assert [out[i].n_shingles for i in range(len(texts))] == sizes
    assert [out[i].component_id for i in range(len(texts))] == roots
    assert all(out[i].kept == (roots[i] == i) for i in out)


def test_estimate_corrects_chance():
    rng = np.random.default_rng(0)
    factors = minhash._multipliers()
    for share in (0.3, 0.6, 0.9):
        got = []
        for _ in range(40):
            pool = minhash.mix(rng.integers(0, 2**63, 400).astype(np.uint64))
            common = int(400 * share / (1 + share) * 2) // 2
            a, b = pool[:200 + common // 2], pool[200 - common // 2:]
            true = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
            pa_, pb = (np.frombuffer(minhash.pack(minhash.minima(x, factors)), np.uint8).reshape(1, -1) for x in (a, b))
            got.append(float(minhash.estimate(minhash.matches(pa_, pb))[0, 0]) - true)
        assert abs(np.mean(got)) < 0.03


# --- suffix arrays --------------------------------------------------------------------

def repeats_brute(texts, n=suffix.LENGTH):
    seen, out = set(), []
    for t in texts:
        b = t.encode()
        covered = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - n + 1):
            w = b[i:i + n]
            if w in seen:
                covered[i:i + n] = True
            seen.add(w)
        c = covered[:len(b)]
        out.append((len(b), int(c.sum()), int((c & ~np.append(False, c[:-1])).sum()),
                    bytes(np.frombuffer(b, np.uint8)[~c])))
    return out


def repeat_texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(2, 9)))
    passages = [" ".join(word() for _ in range(rng.randrange(10, 60))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 40)))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            lo = rng.randrange(0, len(p) // 2)
            parts += [p[lo:lo + rng.randrange(60, 300)], word()]
        texts.append("".join(parts))
    return texts + ["a" * 450, "ab" * 130, "x" * 99, "x" * 100, texts[0], texts[1] * 3]


def test_repeated_strings(spark):
    texts = repeat_texts()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in suffix.remove_repeats(documents(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == repeats_brute(texts)


def test_hot_anchors_are_split(spark, monkeypatch):
    """No shard takes more than HOT contexts of an anchor; the spans stay those of brute force."""
    monkeypatch.setattr(suffix, "HOT", 5)
    monkeypatch.setattr(suffix, "SHARE_BYTES", 2000)
    rng, line = random.Random(2), "a licence line that all hold, of some 50 bytes...."
    rand = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    same = rand(60)
    texts = [rand(90) + line + (same if i % 4 == 0 else rand(60)) + rand(80) for i in range(40)] + repeat_texts()
    edge = rand(20)                    # bytes that a wider anchor takes in before the texts differ
    texts += [rand(90) + edge + line + edge[:i % 19] + rand(80) for i in range(30)]
    most, left, split, widen = [], [], suffix.split_hot, suffix.widened

    def splitting(rows):
        most.append(rows.count())
        cold, spans = split(rows)
        left.extend(r["count"] for part in cold for r in part.groupBy("key").count().collect())
        return cold, spans

    widths = []
    monkeypatch.setattr(suffix, "widened", lambda rows, width: widths.append(width) or widen(rows, width))
    monkeypatch.setattr(suffix, "split_hot", splitting)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in suffix.remove_repeats(documents(spark, texts)).collect()}
    assert most[0] > 30 and left and max(left) <= 5 and len(widths) > 2
    assert [got[i] for i in range(len(texts))] == repeats_brute(texts)


def test_long_texts_are_cut_with_overlaps(spark, monkeypatch):
    monkeypatch.setattr(suffix, "STEP", 700)
    texts = repeat_texts()
    data = "".join(texts).encode()
    whole = np.frombuffer(data, np.uint8)
    powers = suffix.Powers()
    ends, starts = np.array([len(data)]), np.array([0])
    want = suffix.anchors(whole, ends, starts, powers)[0]
    got = []
    for _, _, lo, hi, keep_lo, keep_hi in suffix._jobs(np.array([0, len(data)])):
        at = suffix.anchors(whole[lo:hi], np.array([hi - lo]), np.array([0]), powers)[0] + lo
        got += [x for x in at.tolist() if keep_lo <= x < keep_hi]
    assert got == want.tolist()


@pytest.mark.parametrize("text", ["banana", "mississippi", "aaaaaaa", "abcabcabc", "x", "zyx" * 40, "abracadabra" * 9])
def test_suffix_array(text):
    values = np.append(np.frombuffer(text.encode(), np.uint8).astype(np.int16) + 2, np.int16(0))
    order = suffix.suffix_array(values, 258, suffix.Powers())
    assert order.tolist() == sorted(range(len(values)), key=lambda i: values[i:].tolist())


# --- exact copies, lines ----------------------------------------------------------------

def test_exact_keeps_smallest_too(spark):
    df = documents(spark, ["a", "b", "a", "a ", "b", "a"]).repartition(5)
    out = {r.doc_id: r for r in exact.exact_dedup(df, keep="min").collect()}
    assert [out[i].keep_id for i in range(6)] == [0, 1, 0, 3, 1, 0] and out[0].group_size == 3
    plan = exact.exact_dedup(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_lines_brute(spark):
    rng = random.Random(9)
    texts = ["\n".join(rng.choice("abcd") for _ in range(rng.randrange(1, 14))) for _ in range(80)]
    seen, want = set(), []
    for t in texts:
        l_, gone = t.split("\n"), set()
        for i in range(len(l_) - 2):
            w = tuple(l_[i:i + 3])
            gone |= {i, i + 1, i + 2} if w in seen else set()
            seen.add(w)
        want.append("\n".join(x for i, x in enumerate(l_) if i not in gone))
    got = {r.doc_id: r.text for r in lines.line_dedup(documents(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want


# --- archives ---------------------------------------------------------------------------

def test_archive_round_trip_and_single_reads(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 4096)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    index, folder = warc.archive(pages)
    back = warc.read_bundles(spark, folder, index)
    want = {r.page_id: r.html or "" for r in pages.collect()}
    got = {r.page_id: r for r in back.collect()}
    assert got.keys() == want.keys()
    for k, r in got.items():
        assert (bytes(r.payload).decode() if r.record_type == "response" else want[r.refers_to]) == want[k]
    some = index.filter("page_id % 7 = 3")
    one = {r.record_id: bytes(r.payload or b"") for r in warc.read_records(some, folder).collect()}
    full = {r.record_id: bytes(r.payload or b"") for r in back.collect()}
    assert one and all(full[k] == v for k, v in one.items())


# --- mixing -----------------------------------------------------------------------------

def targets_brute(size, most=3.0):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + ([None] if None in size else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(size.values()))
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] >= most * size[s]}
        if not full:
            return target | {s: unit * weight[s] for s in open_}
        target |= {s: most * size[s] for s in full}
        left -= sum(most * size[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("block", [7, 512])
def test_mix(spark, block):
    rng = random.Random(11)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 40, 300]))),
             rng.choice(["a", "b", "big", "big", "big", "z", "é", None])) for i in range(400)] + [(900, "w " * 9, "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.lit(0).cast("long"))
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    want = targets_brute(size)
    out = mixing.mixed_sizes(df, block=block, shard_slots=16).collect()
    again = mixing.mixed_sizes(df.repartition(3), block=block, shard_slots=16).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))
    source = {i: s for i, _, s in rows}
    taken = Counter()
    for r in out:
        assert r.taken <= 3 * r.size and r.source_size == size[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= 1
    docs = mixing.mixed_documents(df, block=block, shard_slots=16).collect()
    per_doc = Counter()
    for r in docs:
        per_doc[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert all(per_doc[r.doc_id] == r.taken for r in out)
    assert len({r.doc_id for r in out}) == len(rows)


def test_mix_of_repeated_rows(spark):
    # a third of the rows equal in every column, others with one id and size or with no id
    words = lambda n, i: " ".join(f"w{i}" for _ in range(n))
    rows = ([(1, words(9, 0), "a")] * 40 + [(2, words(5, i), "b") for i in range(20)]
            + [(None, words(4, i), None) for i in range(20)] + [(i, words(i % 7, i), "c") for i in range(10, 50)])
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.lit(0).cast("long"))
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    want, taken = targets_brute(size), Counter()
    docs = mixing.mixed_documents(df, block=7, shard_slots=16).collect()
    texts = Counter()
    for r in docs:
        taken[r.source] += len(r.text.split())
        texts[r.text.split()[0]] += len(r.text.split())
    assert all(abs(taken[s] - want[s]) <= 1 for s in size)
    for i in range(20):       # rows of one id stay apart: none beyond three times its own words
        assert texts[f"w{i}"] <= 3 * sum(len(t.split()) for _, t, _ in rows if t.startswith(f"w{i} "))


def test_permutation(spark):
    for n in (1, 2, 7, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("k")).alias("p"))
        assert sorted(r.p for r in df.collect()) == list(range(n))


def test_mix_is_native(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    plan = mixing.mixed_sizes(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- vectors ----------------------------------------------------------------------------

def test_cover_tree(spark, monkeypatch):
    monkeypatch.setattr(cover, "BLOCK", 40)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 16))
    x = np.concatenate([base, base[rng.integers(0, 60, 200)] + rng.normal(size=(200, 16)) * rng.uniform(0, 0.5, (200, 1)),
                        base[:5], base[:5] * 3]).astype(np.float32)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    roots = components(len(x), [tuple(p) for p in np.argwhere(link)])
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    out = {r.vec_id: r for r in cover.near_vectors(df).collect()}
    assert [out[i].n_links for i in range(len(x))] == link.sum(1).tolist()
    assert [out[i].component_id for i in range(len(x))] == roots


# --- toxicity ---------------------------------------------------------------------------

def segments_brute(s):
    """Maximal scoring subsequences by their recursive definition: the best one, then what is
    left and right of it."""
    out = []

    def go(lo, hi):
        best = (0.0, 0, 0)
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += s[j]
                if total > best[0] + 1e-12:
                    best = (total, i, j + 1)
        if best[0] > 0:
            go(lo, best[1])
            out.append(best[1:])
            go(best[2], hi)
    go(0, len(s))
    return out


def test_segments():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 30, 60):
        for _ in range(20):
            s = rng.normal(-0.2, 1, n)
            assert [x[:2] for x in toxic.segments(s)] == segments_brute(s)


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(1)
    bad = ["vile", "scum", "trashy", "moronic"]
    rows, labels = [], []
    for i in range(1500):
        words = [f"w{int(rng.paretovariate(0.6)) % 800}" for _ in range(rng.randrange(20, 300))]
        mark = int(rng.random() < 0.2)
        if mark:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(bad) for _ in range(rng.randrange(2, 6))]
        rows.append((i, " ".join(words)))
        labels.append((i, mark))
    out = toxic.toxicity(spark.createDataFrame(rows, "doc_id long, text string"),
                         spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [(r.predicted, labels[r.doc_id][1]) for r in out if r.held_out]
    assert len(held) > 300 and sum(p == y for p, y in held) >= 0.98 * len(held)
    found = next(r for r in out if labels[r.doc_id][1])
    assert found.segments and found.segments[0].end > found.segments[0].first


# --- language model -----------------------------------------------------------------------

def test_gradient():
    model = gru.Model.start(np.arange(gru.CLASSES * gru.MEMBERS, dtype=float) + 1)
    model.flat[...] += np.random.default_rng(0).normal(0, 0.1, model.flat.shape)
    rng = np.random.default_rng(1)
    inputs, targets = rng.integers(0, 40, (4, 3)), rng.integers(0, 40, (4, 3))
    h = rng.normal(0, 0.5, (3, gru.HIDDEN)).astype(np.float32)
    g, _, loss = model.gradient(inputs, targets, h)
    direct = -model.log_probs(model.steps(inputs, h).reshape(-1, gru.HIDDEN), targets.ravel()).sum()
    assert loss == pytest.approx(direct, rel=1e-4)
    way = g.flat / np.linalg.norm(g.flat)
    ends = []
    for sign in (1, -1):
        m = gru.Model(model.flat + sign * 0.02 * way)
        ends.append(-m.log_probs(m.steps(inputs, h).reshape(-1, gru.HIDDEN), targets.ravel()).sum() / 12)
    assert (ends[0] - ends[1]) / 0.04 == pytest.approx(np.linalg.norm(g.flat), rel=0.02)


def test_windows_carry_the_state():
    model = gru.Model.start(np.ones(gru.CLASSES * gru.MEMBERS))
    model.flat[...] += np.random.default_rng(0).normal(0, 0.3, model.flat.shape)
    rng = np.random.default_rng(1)
    docs = [np.append(rng.integers(1, 200, n), gru.END) for n in (0, 1, 46, 47, 48, 49, 200, 333)]
    got = gru.score(model, docs)
    for value, d in zip(got, docs):
        before = np.concatenate([[gru.END], d[:-1]])[:, None]
        states = model.steps(before, np.zeros((1, gru.HIDDEN), np.float32))[:, 0]
        assert value == pytest.approx(model.log_probs(states, d).sum(), rel=1e-4)


def test_probabilities_sum_to_one():
    model = gru.Model.start(np.arange(gru.CLASSES * gru.MEMBERS) - 1.0)
    state = np.random.default_rng(0).normal(0, 1, (1, gru.HIDDEN)).astype(np.float32)
    n = gru.CLASSES * gru.MEMBERS
    total = np.exp(model.log_probs(np.repeat(state, n, 0), np.arange(n)).astype(float)).sum()
    assert total == pytest.approx(1, abs=1e-4)


def test_the_model_grows_with_the_vocabulary():
    sides = []
    for distinct in (10_000, 5_000_000, 80_000_000):
        rows = [(b"", 50_000)] + [(b"w%d" % i, 100_000 - i) for i in range(90_000)]
        lexicon = lm.Lexicon(rows, 10**10, distinct)
        own = int((lexicon.model_counts > 0).sum())
        assert own >= min(len(rows), distinct / lm.OWN_SHARE) and lexicon.model.max() == own - 1
        model = gru.Model.start(lexicon.model_counts)
        again = gru.Model(model.flat)
        assert again.side == model.side and again.side ** 2 == len(lexicon.model_counts)
        assert (again.ww == model.ww).all()
        sides.append(again.side)
    assert sides == [36, 71, 283]
    assert all(gru.Model(side=n).side == gru.Model(gru.Model(side=n).flat).side == n for n in range(1, 450, 7))


def test_a_gradient_takes_little_new_room():
    """Room is used again from window to window, and what it held before does not matter."""
    model = gru.Model.start(np.arange(gru.CLASSES * gru.MEMBERS, dtype=float) + 1)
    rng = np.random.default_rng(1)
    windows = [(rng.integers(0, n, (gru.WINDOW, gru.STREAMS)), rng.integers(0, n, (gru.WINDOW, gru.STREAMS))) for n in (1296, 30, 1296)]
    h = rng.normal(0, 0.5, (gru.STREAMS, gru.HIDDEN)).astype(np.float32)
    g = gru.Model()
    for inputs, targets in windows:
        fresh, state, loss = gru.Model(model.flat).gradient(inputs, targets, h)
        tracemalloc.start()
        again = model.gradient(inputs, targets, h, True, g)
        used = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert (again[0].flat == fresh.flat).all() and (again[1] == state).all() and again[2] == loss
    assert used < 1 << 20        # 5.8 MB (10**6 bytes) before


def test_own_words_without_their_places():
    lexicon = lm.Lexicon([(b"", 50)] + [(b"w%d" % i, 9000 - i) for i in range(3000)], 10**8, 3001)
    own, place = lexicon.own(), lexicon.places()
    words = [b"", b"w0", b"w1293", b"w1294", b"w2999", b"none"]
    assert [own.get(w, gru.UNK) for w in words] == lexicon.model[[place[w] for w in words]].tolist()
    assert len(own) == lexicon.n_own


def test_chunks_of_parameters_meet_again(spark, monkeypatch):
    """The average over partitions does not depend on how the vector is cut."""
    docs = documents(spark, [" ".join(f"w{(i * j) % 50}" for j in range(60)) for i in range(40)]).repartition(3, "doc_id")
    lexicon = lm.Lexicon([(b"", 40)] + [(b"w%d" % i, 100 - i) for i in range(50)], 5000, 50)
    flat = gru.Model.start(lexicon.model_counts).flat
    whole = lm.train(docs, lexicon, flat, 0.01, 1)
    monkeypatch.setattr(lm, "CHUNK", 1000)
    assert np.allclose(lm.train(docs, lexicon, flat, 0.01, 1), whole, atol=1e-6) and not np.allclose(whole, flat)


def test_the_tail_of_a_slice_is_learnt():
    """A word that only the tail holds gets likelier."""
    model = gru.Model.start(np.ones(gru.CLASSES * gru.MEMBERS))
    trainer = gru.Trainer(model, 0.01)
    sequence = np.full(16 * 3 + 2, 2)
    sequence[-1] = 1000
    before = model.bw.copy()
    trainer.feed(sequence)
    assert trainer.tokens == len(sequence)
    assert model.bw[1000 // model.side, 1000 % model.side] > before[1000 // model.side, 1000 % model.side]


def test_the_warm_up_scans_in_parallel(spark, monkeypatch):
    """The one task of the warm-up reads a stored sample, not the table."""
    seen, train = [], lm.train
    monkeypatch.setattr(lm, "train", lambda docs, *rest: seen.append(docs.inputFiles()) or train(docs, *rest))
    docs = stored(documents(spark, [f"some words {i}" for i in range(200)]).repartition(4))
    lm.log_likelihood(docs)
    assert len(seen) == 2 and seen[0] and not {*seen[0]} & {*docs.inputFiles()}


def test_language_model(spark):
    import zlib
    rng = random.Random(7)
    texts = []
    for _ in range(500):
        side = rng.choice(["left", "right"])
        texts.append(" ".join(f"{side}{rng.randrange(30)}" if rng.random() < 0.9 else f"rare{rng.randrange(10**6)}"
                              for _ in range(rng.randrange(5, 60))))
    counts, folds = Counter(), {}
    for i, t in enumerate(texts):
        folds[i] = zlib.crc32(str(i).encode()) % 10 == 0
        if not folds[i]:
            counts.update([*t.encode().lower().split(), b""])
    n, v = sum(counts.values()), len(counts)
    out = {r.doc_id: r for r in lm.log_likelihood(documents(spark, texts)).collect()}
    better = []
    for i, t in enumerate(texts):
        tokens = [*t.encode().lower().split(), b""]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        assert out[i].base_score == pytest.approx(base, rel=1e-9) and out[i].held_out == folds[i]
        assert (out[i].n_tokens, out[i].n_known) == (len(tokens), sum(counts[w] > 0 for w in tokens))
        assert out[i].train_tokens == n
        if folds[i]:
            better.append(out[i].score > out[i].base_score)
    assert sum(better) >= 0.8 * len(better)


# --- pieces -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def lattice():
    return pieces.Lattice(pieces.Vocabulary(pieces.public_model()))


def all_segmentations(v, raw):
    raw = b" " + raw
    out = []

    def go(at, ids, weight):
        if at == len(raw):
            out.append((tuple(ids), weight))
            return
        for k in range(1, v.longest + 1):
            found = v.pieces.get(raw[at:at + k])
            if found and at + k <= len(raw):
                go(at + k, [*ids, found[0]], weight + found[1])
        byte = raw[at]
        width = 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
        if byte & 0xC0 == 0x80 or raw[at:at + width] not in v.pieces:
            go(at + 1, [*ids, v.byte_ids[byte]], weight + v.byte_weight)
    go(0, [], 0.0)
    total = math.log(sum(math.exp(w) for _, w in out))
    return {ids: w - total for ids, w in out}


def test_samples_without_replacement(lattice):
    """Chances of the first sample, distinctness, and inclusion scores that add up."""
    raw = "the cat\n▁é".encode()
    want = all_segmentations(lattice.v, raw)
    first, n, total = Counter(), 3000, 0.0
    for key in range(n):
        found = pieces.sample(lattice, [raw], [key], 3)[0]
        ids = [tuple(lattice.piece[p.edges].tolist()) for p, _ in found]
        assert len(set(ids)) == 3 and all(i in want for i in ids)
        values = [p.value for p, _ in found]
        assert values == sorted(values, reverse=True)
        for i, (p, inclusion) in zip(ids, found):
            assert p.before[-1] == pytest.approx(want[i])
            total += math.exp(want[i] - inclusion)
        first[ids[0]] += 1
    for ids, w in sorted(want.items(), key=lambda x: -x[1])[:5]:
        p = math.exp(w)
        assert abs(first[ids] / n - p) < 5 * math.sqrt(p / n)
    assert total / n == pytest.approx(1, abs=0.05)     # weights by inclusion are unbiased


def test_all_segmentations_of_a_short_text(lattice):
    want = all_segmentations(lattice.v, b"hi")
    found = pieces.sample(lattice, [b"hi"], [5], len(want) + 5)[0]
    assert {tuple(lattice.piece[p.edges].tolist()) for p, _ in found} == set(want)
    assert all(inclusion == pytest.approx(0) for _, inclusion in found)


def all_paths(v, raw):
    """(log of the summed weights of all segmentations, their number), without any cut."""
    raw = b" " + raw
    z, n = [0.0] * (len(raw) + 1), [1] * (len(raw) + 1)
    for at in range(len(raw) - 1, -1, -1):
        edges = [(k, v.pieces[raw[at:at + k]][1]) for k in range(1, min(v.longest, len(raw) - at) + 1)
                 if raw[at:at + k] in v.pieces]
        byte = raw[at]
        width = 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
        if byte & 0xC0 == 0x80 or raw[at:at + width] not in v.pieces:
            edges.append((1, v.byte_weight))
        top = max(w + z[at + k] for k, w in edges)
        z[at] = top + math.log(sum(math.exp(w + z[at + k] - top) for k, w in edges))
        n[at] = sum(n[at + k] for k, _ in edges)
    return z[0], n[0]


def lattice_paths(lattice, raw):
    """The same of the lattice."""
    words = lattice.v.words(b" " + raw)
    assert b"".join(words) == b" " + raw
    states = lattice.states_of([words], len(words))
    n = {0: 1}

    def paths(state):
        todo = [state]
        while todo:
            s = todo[-1]
            to = lattice.next[lattice.first[s - 1]:lattice.first[s]].tolist() if s else []
            wait = [x for x in to if x not in n]
            if wait:
                todo += wait
                continue
            n.setdefault(s, sum(n[x] for x in to))
            todo.pop()
        return n[state]
    return lattice.log_z[states].sum(), math.prod(paths(s) for s in states.tolist())


@pytest.mark.parametrize("block", [64, pieces.BLOCK])
@pytest.mark.parametrize("text", [
    "是的我们在这里说明一个很长的句子" * 9, "これは空白のない長い文章ですから" * 9, "ภาษาไทยไม่มีช่องว่างระหว่างคำ" * 9,
    "https://example.com/internationalization/list[:internationalization_of]?q=" + "abcInternational" * 30,
    "QWxsIGhhbmRzIG9uIGRlY2s" * 30, "(-internationalization", "list[:internationalization_of]", "(?international",
    "a" + " " * 100 + "b", "x" + "." * 150 + "y", "-" * 300 + "internationalization"])
def test_no_segmentation_is_cut(text, block, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", block)
    lattice = pieces.Lattice(pieces.Vocabulary(pieces.public_model()))
    log_z, n = lattice_paths(lattice, text.encode())
    want_z, want_n = all_paths(lattice.v, text.encode())
    assert n == want_n
    assert log_z == pytest.approx(want_z)


def test_texts_without_spaces_keep_their_characters(lattice):
    """The four kinds at lengths that can be listed: the lattice has just these segmentations."""
    for text in ("是的", "ですね", "ไทย", "a.co/x", "QWxs"):
        want = all_segmentations(lattice.v, text.encode())
        found = pieces.sample(lattice, [text.encode()], [3], len(want) + 5)[0]
        assert {tuple(lattice.piece[p.edges].tolist()) for p, _ in found} == set(want)
    text = ("是" * 400).encode()
    path = pieces.sample(lattice, [text], [1], 1)[0][0][0]
    assert set(lattice.piece[path.edges].tolist()) <= {lattice.v.pieces["是".encode()][0], lattice.v.pieces[b" "][0]}


def test_long_words_walk_alike(lattice, monkeypatch):
    text = b"QWxsIGhhbmRzIG9uIGRlY2s" * 40
    walk = lambda: [(p.edges.tolist(), p.value) for p, _ in pieces.sample(lattice, [text], [4], 3)[0]]
    one_by_one = walk()
    monkeypatch.setattr(pieces, "FEW", 0)
    assert walk() == one_by_one
    assert lattice.v.decode(lattice.piece[one_by_one[0][0]]) == text


def test_encode_decode(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    encoded = stored(pieces.encode(df, samples=2))
    assert encoded.filter("not exact").count() == 0
    text = {r.doc_id: r.text for r in df.collect()}
    assert all(text[r.doc_id] == r.text for r in pieces.decode(encoded).collect())
    again = pieces.encode(df.repartition(5), samples=2)
    assert encoded.exceptAll(again).count() == 0


# --- pipeline ---------------------------------------------------------------------------

def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        at = stored(stage(spark, at, SF))
        if name == "toxicity":
            bad = {r.doc_id for r in toxic.toxicity(docs, labels).filter("predicted = 1").collect()}
            assert {r.doc_id for r in at.collect()} == {r.doc_id for r in docs.collect()} - bad
        if name == "exact dedup":
            texts = [r.text for r in at.collect()]
            assert len(texts) == len(set(texts))
        if name == "near dedup":
            rows = at.orderBy("doc_id").collect()
            _, roots = near_brute([r.text for r in rows], corpus_pipeline.NEAR_PERCENT)
            assert roots == list(range(len(rows)))
        if name != "pieces":
            assert at.columns == corpus_pipeline.COLUMNS and at.count() > 0
    assert at.filter("not exact").count() == 0
    assert corpus_pipeline.run(spark, SF).count() == at.count()
