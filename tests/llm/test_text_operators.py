"""Operators on texts against brute force: substring dedup, Jaccard join, fingerprints, LM scoring."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from lakepulse.llm import fingerprints as fingerprint_module
from lakepulse.llm import lm_scoring, ngram_join, text
from lakepulse.llm.fingerprints import compare_with_edits, edited, fingerprints, likeness
from lakepulse.llm.ngram_join import link_documents
from lakepulse.llm.substring_dedup import repeated_windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, block long, answers string"


def words(t):
    return WORD.findall(t or "")


def lowered(t):
    return words((t or "").translate({c: c + 32 for c in range(65, 91)}))


def passage(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghé中"), 4)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Nulls, empty, white space only, short, long, exact and near copies, shared passages, and names that clash with inner columns."""
    shared, base = passage(1, 60), passage(2, 80)
    near = base.split()
    texts = [None, "", " \t\n", "one", "one two three", base, base, base.upper(), " ".join([*near[:79], "changed"]), " ".join([*near[:40], "x", *near[41:]]), shared + " " + passage(3, 30), passage(4, 25) + "\n" + shared, passage(5, 3000), "a " * 100, "a " * 50, "word joined　too " * 12]
    texts += [f"{shared} tail {i}" for i in range(8)] + ["same same same same"] * 5
    return [(i, t, 7, "clash") for i, t in enumerate(texts)]


def test_words_and_hashes_do_not_depend_on_place():
    column = pa.array(["b a", None, "", "a  b\x0bc", "A b"])
    w = text.split(column)
    assert w.counts.tolist() == [2, 0, 0, 3, 2]
    h = text.hashes(w)
    assert h[1] == h[2] and h[0] == h[3] and h[5] != h[1]
    assert text.hashes(text.split(column, lower=True))[5] == h[1]


def brute_kept(rows, n):
    seen, out = set(), {}
    for i, t in sorted((r[0], r[1] or "") for r in rows):
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - n + 1):
            k = tuple(w[s : s + n])
            if k in seen:
                gone[s : s + n] = [True] * n
            seen.add(k)
        out.setdefault(i, []).append((len(w), sum(gone), " ".join(a for a, b in zip(w, gone) if not b)))
    return out


def test_substring_dedup(spark, corpus):
    rows = [*corpus, (5, corpus[5][1], 7, "repeated row")]
    got = {}
    for r in repeated_windows(spark.createDataFrame(rows, SCHEMA)).collect():
        assert r.row.answers in ("clash", "repeated row")
        got.setdefault(r.row.doc_id, []).append((r.n_words, r.n_removed, r.kept))
        assert sum(e - s for s, e in r.removed) == r.n_removed
    want = brute_kept(rows, 20)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert repeated_windows(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("window, until", [(10, None), (20, None), (20, 80), (20, 20)])
def test_substring_levels(spark, corpus, window, until):
    """The greatest level at which a document has a window that occurs again anywhere."""
    long = passage(8, 700)
    rows = [*corpus, (50, long, 7, ""), (51, "x " + long, 7, ""), (52, " ".join(long.split()[100:430]), 7, ""), (53, "r " * 85, 7, ""), (50, None, 7, "null"), (None, long[:300], 7, "")]
    texts = [words(r[1]) for r in rows]
    want, n = [0] * len(texts), window
    while until is None or n <= until:
        count = Counter(tuple(w[s : s + n]) for w in texts for s in range(len(w) - n + 1))
        own = [any(count[tuple(w[s : s + n])] > 1 for s in range(len(w) - n + 1)) for w in texts]
        want = [n if o else x for o, x in zip(own, want)]
        if not any(own):
            break
        n *= 2
    got = repeated_windows(spark.createDataFrame(rows, SCHEMA), window, until).select("row.doc_id", "row.answers", "n_words", "longest").collect()
    assert sorted(map(str, ((r.doc_id, r.answers, r.n_words, r.longest) for r in got))) == sorted(map(str, ((r[0], r[3], len(w), x) for r, w, x in zip(rows, texts, want))))
    assert until is not None or max(want) >= 640 / (20 / window if window < 20 else 1)


def brute_components(rows, n, percent, split):
    sets = {}
    for i, t, *_ in rows:
        w = split(t)
        sets[i] = {tuple(w[s : s + n]) for s in range(max(1, len(w) - n + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("frequent_df", [0, 32])
def test_jaccard_join(spark, corpus, frequent_df):
    found = link_documents(spark.createDataFrame([*corpus, (None, "one", 1, "")], SCHEMA), frequent_df=frequent_df).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert got.pop(None) == (1, None)
    assert got == brute_components(corpus, 4, 85, lowered)


@pytest.mark.parametrize("edits", [3, 4, 6])
def test_jaccard_join_of_near_copies_around_the_threshold(spark, monkeypatch, edits):
    """A large group whose members lie just above and below the threshold of each other, in blocks much smaller than it."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 16)
    rng, base, rows = np.random.default_rng(edits), passage(21, 160).split(), []
    for i in range(240):
        own = list(base)
        for k in rng.choice(160, edits, replace=False):
            own[k] = f"edit{rng.integers(0, 3)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, passage(100 + i, 50)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in link_documents(docs).collect()}
    assert got == brute_components(rows, 4, 85, lowered)


def test_jaccard_join_of_one_id_with_several_texts(spark):
    a, b = passage(31, 40), passage(32, 40)
    rows = [(5, a), (5, b), (7, a), (3, b + " end"), (5, a), (9, None), (9, a + " x")]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, 37, 3), (7, 37, 3), (3, 38, 3), (9, 0, 9), (9, 38, 3)}


def test_jaccard_join_of_nothing(spark):
    assert link_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_edits_and_fingerprints(spark, corpus):
    found = {r.doc_id: r for r in compare_with_edits(spark.createDataFrame(corpus, SCHEMA)).collect()}
    order = sorted(((i, t or "") for i, t, *_ in corpus), reverse=True)
    assert len(found) == len(order)
    for k, (i, t) in enumerate(order):
        changed = edited(t, order[(k + 1) % len(order)][1])
        assert (found[i].n_chars, found[i].edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert 0 <= found[i].near_edited <= 1 and 0 <= found[i].near_next <= 1
    assert found[5].fingerprint == found[6].fingerprint and found[0].fingerprint == found[1].fingerprint == ""
    assert compare_with_edits(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("filled", [1, 2, 3, 40, 512])
def test_densification_probes_until_a_full_bin(filled):
    rng = np.random.default_rng(filled)
    full = np.zeros((3, 512), bool)
    full[1, rng.choice(512, filled, replace=False)] = full[2, 7] = True
    values = rng.integers(0, 2**63, (3, 512), dtype=np.uint64)
    got = fingerprint_module.densify(values, full)
    assert (got[0] == values[0]).all() and (got[2] == values[2, 7]).all()
    for c in range(512):
        k, at = 0, c
        while not full[1, at]:
            at, k = int(fingerprint_module.probe(np.array([c]), k, 512)[0]), k + 1
        assert got[1, c] == values[1, at]


def test_next_documents_over_many_ranges(spark):
    rows = [(int(i), f"text {i}") for i in np.random.default_rng(1).permutation(400)] + [(7, "again"), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = {(i, hashlib.sha256(edited(t, order[(k + 1) % len(order)][1]).encode()).hexdigest()) for k, (i, t) in enumerate(order)}
    dealt = fingerprint_module.with_next(docs, 20)
    assert dealt.select("part").distinct().count() > 3
    assert {(r.doc_id, r.edited_sha256) for r in compare_with_edits(docs).collect()} == want


def test_likeness_follows_jaccard():
    base = passage(9, 600).split()
    error = []
    for cut in (30, 120, 240, 420):
        other = base[cut:] + passage(cut, cut).split()
        a, b = (fingerprints(pa.array([" ".join(w)])) for w in (base, other))
        x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (base, other))
        error.append(likeness(a[0], b[0], a[1], b[1])[0] - len(x & y) / len(x | y))
    assert max(map(abs, error)) < 0.1


def test_base_scores_and_model(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(10**9, None), (10**9 + 1, ""), (None, "the THE")], "doc_id long, text string"))
    rows = [(r.doc_id, [*lowered(r.text), None]) for r in docs.collect()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    count = Counter(w for i, ws in rows if not held(i) for w in ws)
    n, v = sum(count.values()), len(count)
    got = {r.doc_id: r for r in lm_scoring.score_documents(docs).collect()}
    assert len(got) == len(rows)
    for i, ws in rows:
        r = got[i]
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(ws), sum(count[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    out = [got[i] for i, _ in rows if held(i)]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_network_gradient():
    rng = np.random.default_rng(0)
    net = lm_scoring.Network.new(rng.uniform(0.1, 1, lm_scoring.CLASSES))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    n = lm_scoring.LENGTH
    kind, target = rng.integers(0, lm_scoring.CLASSES, (2, 2, n))
    vector = rng.standard_normal((2, n, lm_scoring.VECTOR))
    valid = np.array([[True] * n, [False] * 20 + [True] * (n - 20)])
    begins = np.zeros((2, n), bool)
    begins[1, 20] = True
    _, grad = net.gradient(kind, vector, begins, valid, target)
    assert set(grad) == set(net.p)
    for name, p in net.p.items():
        for at in {np.unravel_index(np.abs(grad[name]).argmax(), p.shape), tuple(d // 2 for d in p.shape)}:
            eps, before = 1e-5, p[at]
            p[at] = before + eps
            up = net.gradient(kind, vector, begins, valid, target)[0]
            p[at] = before - eps
            down = net.gradient(kind, vector, begins, valid, target)[0]
            p[at] = before
            assert grad[name][at] == pytest.approx((up - down) / (2 * eps), abs=1e-6), name


def brute_class_scores(net, kind, vector):
    """log10 of the probability of each token's class of one text: a loop over tokens, plain attention over the inputs of its window."""
    p, out = {k: v.astype(float) for k, v in net.p.items()}, []
    for t in range(len(kind)):
        place = lm_scoring.LENGTH - lm_scoring.STRIDE + t % lm_scoring.STRIDE  # in the window
        x = np.array([(p["start"] if j == 0 else p["kind"][kind[j - 1]] + vector[j - 1] @ p["vector"]) + p["place"][place - (t - j)] for j in range(max(0, t - place), t + 1)])
        s = (x @ p["k"]) @ (x[-1] @ p["q"]) / np.sqrt(lm_scoring.SIZE)
        a = np.exp(s - s.max())
        h = x[-1] + (a / a.sum()) @ (x @ p["v"]) @ p["o"]
        z = np.maximum(h @ p["w1"] + p["b1"], 0) @ p["w2"] + p["b2"]
        out.append((z[kind[t]] - z.max() - np.log(np.exp(z - z.max()).sum())) / np.log(10))
    return out


def test_scores_against_brute_force(spark, monkeypatch):
    """Every token is scored once, from the network's class and the word's share in its class, both computed by loops here."""
    texts = [None, "", "one Word", *(passage(i, n) + " end of it" for i, n in enumerate([3, 46, 47, 48, 49, 95, 97, 200, 333] * 3))]
    docs, seen, learn = list(enumerate(texts)), {}, lm_scoring.train

    def record(windows, classes, network, **more):
        seen["classes"], seen["network"] = classes, learn(windows, classes, network, rounds=1)
        return seen["network"]

    monkeypatch.setattr(lm_scoring, "train", record)
    got = {r.doc_id: r for r in lm_scoring.score_documents(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score long").repartition(3), rate=2).collect()}
    encode = lm_scoring.encoder(lm_scoring.default_vocabulary()).encode_ordinary
    rows = {i: [encode(" " + w) for w in lowered(t)] + [[]] for i, t in docs}
    flat = lambda ws: (np.array([i for w in ws for i in w], np.int64), np.array([len(w) for w in ws]))
    kind = {i: seen["classes"].words(*flat(ws)) for i, ws in rows.items()}
    count, of_class = Counter(), {}
    for i, t in docs:
        if not lm_scoring.held_out_id(i):
            for w, k in zip([*lowered(t), None], kind[i][0].tolist()):
                count[w] += 1
                of_class.setdefault(k, []).append(w)
    for i, t in docs:
        want = sum(brute_class_scores(seen["network"], *kind[i]))
        for w, k in zip([*lowered(t), None], kind[i][0].tolist()):
            own = of_class.get(k, [])
            want += math.log10((count[w] + 0.1) / (len(own) + 0.1 * (len(set(own)) + 1)))
        assert got[i].score == pytest.approx(want, rel=1e-4), i


def test_windows_score_each_token_once():
    tokens = lm_scoring.Tokens(pa.array([None, "a", "b " * 47, "c " * 48, "d " * 500, ""]), lm_scoring.default_vocabulary())
    at, valid = tokens.windows()
    own = at[:, -lm_scoring.STRIDE :][valid[:, -lm_scoring.STRIDE :]]
    assert sorted(own.tolist()) == list(range(len(tokens.of)))


def test_tokens_are_packed_and_unpacked():
    tokens = lm_scoring.Tokens(pa.array([None, "A b  b", "", "c é中 " * 9]), lm_scoring.default_vocabulary())
    again = lm_scoring.Tokens.unpacked(tokens.packed())
    assert again.n == tokens.n and all((getattr(again, k) == getattr(tokens, k)).all() for k in ("first", "of", "row", "size", "ids"))


def test_what_is_learned_from_grows_with_the_input():
    """Windows are taken at one rate from all training texts; statistics of subword ids are sums over all of them."""
    column = pa.array([passage(i, 400) for i in range(60)])
    tokens, trained = lm_scoring.Tokens(column, lm_scoring.default_vocabulary()), np.arange(60) % 3 > 0
    every = lm_scoring.Windows.chosen(tokens, trained, 1)
    some = lm_scoring.Windows.chosen(tokens, trained, 4)
    assert len(every.size) == 40 * -(-401 // lm_scoring.STRIDE) and 0.15 * len(every.size) < len(some.size) < 0.35 * len(every.size)
    again = lm_scoring.Windows.unpacked(some.packed(), len(some.size))
    assert (again.ids == some.ids).all() and (again.size == some.size).all()
    whole, parts = lm_scoring.Statistics(), lm_scoring.Statistics()
    whole.add(tokens, trained)
    for s in range(0, 60, 7):
        parts.add(lm_scoring.Tokens(column[s : s + 7], lm_scoring.default_vocabulary()), trained[s : s + 7])
    assert whole.sums[:, 0].sum() == sum(len(w) for i in range(60) if trained[i] for w in [tokens.ids[np.repeat(np.arange(len(tokens.size)), tokens.size) == k] for k in tokens.of[tokens.row == i]])
    assert parts.sums == pytest.approx(whole.sums, abs=1e-3)
    assert lm_scoring.Statistics.summed([d for _, d in whole.rows()]) == pytest.approx(whole.sums, rel=1e-5)


def test_scores_of_an_empty_table_and_of_repeated_rows(spark):
    schema = "doc_id long, text string, part double, n long"
    assert lm_scoring.score_documents(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c", 0.0, 1), (1, "a b c", 0.0, 1), (2, "x " * 3000, 0.0, 1), (None, None, None, None)]
    got = lm_scoring.score_documents(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 4 and len({r.score for r in got if r.doc_id == 1}) == 1 and all(math.isfinite(r.score) for r in got)


@pytest.mark.parametrize("texts", [["only one"], ["b two", None, "a one", "c three"]])
def test_fingerprints_of_rows_without_ids(spark, texts):
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    order = sorted(t or "" for t in texts)
    want = [hashlib.sha256(edited(t, o).encode()).hexdigest() for t, o in zip(order, order[1:] + order[:1])]
    assert sorted(r.edited_sha256 for r in compare_with_edits(docs).collect()) == sorted(want)


def test_every_training_window_is_learned_from(spark, monkeypatch):
    """Without a rate all windows of all training texts are in the steps: the tokens they predict are all training tokens, each once a pass."""
    texts = [None, "", "one Word", *(passage(i, n) for i, n in enumerate([3, 31, 32, 33, 200, 333] * 4))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    learn, found = lm_scoring.train, {}

    def counted(texts, classes, network, **more):
        rows = texts.collect()
        for rounds in (1, 2):
            n = 0
            for r in range(rounds):
                for row in rows:
                    tokens = lm_scoring.Tokens.unpacked(row.data)
                    trained = np.array([not lm_scoring.held_out_id(i) for i in row.doc_ids])
                    places = lm_scoring.Windows.places(tokens, trained)[r::rounds]
                    *_, valid, _ = lm_scoring.Windows.of_tokens(tokens, places).arrays(*classes.words(tokens.ids, tokens.size))
                    n += int(valid[:, -lm_scoring.STRIDE :].sum())
            found[rounds] = n
        found["more"] = more
        return learn(texts, classes, network, **more)

    monkeypatch.setattr(lm_scoring, "train", counted)
    scored = lm_scoring.score_documents(docs).collect()
    want = sum(len(lowered(t)) + 1 for i, t in enumerate(texts) if not lm_scoring.held_out_id(i))
    assert found == {1: want, 2: want, "more": {"rate": 1}} and scored[0].train_tokens == want


def test_gradient_of_the_last_positions():
    """Context positions are inputs only: their targets don't count, and the gradient is that of the loss of the others."""
    rng = np.random.default_rng(1)
    net = lm_scoring.Network.new(rng.uniform(0.1, 1, lm_scoring.CLASSES))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    n, own = lm_scoring.LENGTH, lm_scoring.STRIDE
    kind, target = rng.integers(0, lm_scoring.CLASSES, (2, 2, n))
    vector, valid, begins = rng.standard_normal((2, n, lm_scoring.VECTOR)), np.ones((2, n), bool), np.zeros((2, n), bool)
    loss, grad = net.gradient(kind, vector, begins, valid, target, own)
    other = target.copy()
    other[:, : n - own] = 0
    assert net.gradient(kind, vector, begins, valid, other, own)[0] == loss
    for name in ("kind", "place", "k", "q", "w2", "vector"):
        p = net.p[name]
        at = np.unravel_index(np.abs(grad[name]).argmax(), p.shape)
        before = p[at]
        p[at] = before + 1e-5
        up = net.gradient(kind, vector, begins, valid, target, own)[0]
        p[at] = before - 1e-5
        down = net.gradient(kind, vector, begins, valid, target, own)[0]
        p[at] = before
        assert grad[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6), name


def test_words_are_encoded_together(monkeypatch):
    """The ids of many words are those of each word alone, also where spaces that don't part words would run on; one call encodes a block."""
    vocabulary = lm_scoring.default_vocabulary()
    encode = lm_scoring.encoder(vocabulary).encode_ordinary
    plain = ["a", "it's", "'s", "'", "1234567", "x1y", "<|endoftext|>", "---", "中文", "é", "\U0001f642", "\x00", "́x", "don't", "ab" * 300, *passage(4, 80).split()]
    odd = [" x", "x ", "　", "y  ", "\x85z", "a b", " ", "\x1c", "\x1dq"]
    lm_scoring.subwords([b"a"], vocabulary)
    calls, (found, leads) = [], lm_scoring._encoder

    class Counted:
        def __getattr__(self, name):
            calls.append(name)
            return getattr(found, name)

    monkeypatch.setattr(lm_scoring, "_encoder", (Counted(), leads))
    mixed = [w for pair in zip(odd, plain) for w in pair] + plain[len(odd) :] + odd[::-1]
    for words, most in ((plain, 1), (mixed, 1 + len(mixed)), (odd, len(odd)), ([], 0)):
        calls.clear()
        ids, size = lm_scoring.subwords([w.encode() for w in words], vocabulary)
        want = [encode(" " + w) for w in words]
        assert size.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w] and len(calls) <= most


def test_steps_of_many_windows_are_large():
    """A task takes LEAST_STEPS steps, however few its windows are; once it has, steps are of LARGE_BATCH windows."""
    rng, sizes = np.random.default_rng(0), []

    class Steps:
        steps = 0
        network = None

        def step(self, grad):
            self.steps += 1

    adam = Steps()
    adam.network = type("Counted", (), {"gradient": lambda self, *x: sizes.append(len(x[0])) or (0.0, {})})()
    n = lm_scoring.HELD
    for _ in range(3):
        assert lm_scoring._learn([(np.arange(n),) * 5], adam, rng) == n
    first, more = -(-n // (n // lm_scoring.LEAST_STEPS)), n // lm_scoring.LARGE_BATCH
    assert lm_scoring.LEAST_STEPS <= first == len(sizes) - 2 * more and sum(sizes) == 3 * n
    assert sizes[first:] == [lm_scoring.LARGE_BATCH] * (2 * more)


def test_rows_that_would_vanish_have_their_own_shift():
    z = np.array([[0.0, -1.0, -2.0], [300.0, 299.0, -1e4], [-500.0, -501.0, -500.0]], np.float32)
    want = [[math.exp(x - max(r)) / sum(math.exp(y - max(r)) for y in r) for x in r] for r in z.tolist()]
    out, whole, shift = lm_scoring._powers(z.copy())
    assert out / whole[:, None] == pytest.approx(np.array(want), rel=1e-5)
    assert shift + np.log(whole) == pytest.approx(np.array([0.40760596, 300.3132617, -499.1380]), rel=1e-5)
