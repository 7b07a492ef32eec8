"""MinHash groups, whitening and the prefix trie against plain brute-force versions on small, odd tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from strata.llm import minhash_dedup, prefix_trie, whitening

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=str)


# MinHash near-duplicates

DOCS = "doc_id BIGINT, text STRING, node STRING, bucket INT, component ARRAY<INT>"


def _shingles(text, n):
    words = (text or "").encode().translate(LOWER).split()
    return {tuple(words)} if 0 < len(words) < n else {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def _groups(rows, n, percent):
    """Expected rows by comparing all pairs."""
    sets = [_shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[root(i)].append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        least = min((d for d in ids[root(i)] if d is not None), default=None)
        out.append((doc, len(sets[i]), least, doc is not None and doc == least))
    return out


def _prose(r, n, letters="abcdefgh"):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, 6))) for _ in range(n))


def _texts():
    r = random.Random(11)
    texts = [None, "", " \t\r\n\x0b\x0c ", "a", "A", "b a", "a b c", "A B\tc", "x" * 5000, "one two three four", "ONE two  three four", "é ü 漢",
             "é ü 漢 字", _prose(r, 6000)]
    for size in (5, 8, 12, 40, 90, 400):
        base = _prose(r, size).split()
        for share in (0, 0.01, 0.03, 0.06, 0.1):
            for _ in range(5):
                texts.append(" ".join(w if r.random() >= share else _prose(r, 1) for w in base))
        texts += [" ".join(base[:k]) for k in (size - 1, size - 2, int(size * 0.83))]
    return texts + texts[:20]


TEXTS = _texts()
ROWS = [(i if i % 13 != 4 else None if i % 2 else 40, t) for i, t in enumerate(TEXTS)]


@pytest.mark.parametrize("n, percent", [(4, 80), (5, 80), (3, 90)])
def test_minhash_groups(spark, n, percent):
    docs = spark.createDataFrame([(*row, "clash", 1, [2]) for row in ROWS], DOCS).repartition(3)
    assert _sorted(minhash_dedup.cluster(docs, n, percent).collect()) == _sorted(_groups(ROWS, n, percent))


def test_minhash_of_nothing(spark):
    assert minhash_dedup.cluster(spark.createDataFrame([], DOCS)).collect() == []
    blank = spark.createDataFrame([(1, None), (None, ""), (1, " ")], "doc_id BIGINT, text STRING")
    assert _sorted(minhash_dedup.cluster(blank).collect()) == _sorted([(1, 0, 1, True), (None, 0, None, False), (1, 0, 1, True)])


def test_hubs_meet_everybody(spark):
    """One bucket whose first hub is similar to nobody, and two groups behind it: later rounds must find both."""
    r = random.Random(5)
    common = _prose(r, 60).split()
    texts = ["".join(r.choice("xyz") for _ in range(9)) + " " + " ".join(common[:40])]
    for tail in (_prose(r, 30), _prose(r, 30)):
        texts += [" ".join([*common, tail, _prose(r, 1)]) for _ in range(70)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert _sorted(minhash_dedup.cluster(docs, 4, 80).collect()) == _sorted(_groups(rows, 4, 80))


def test_edges_of_a_group_of_copies_are_a_star(spark, monkeypatch):
    r = random.Random(9)
    base = _prose(r, 300).split()
    texts = [" ".join([*base[:i], _prose(r, 1), *base[i:]]) for i in range(0, 300, 2)]
    seen = []
    verify = minhash_dedup._verify
    monkeypatch.setattr(minhash_dedup, "_verify", lambda edges, *a: seen.append(edges.count()) or verify(edges, *a))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    assert {c.component_id for c in minhash_dedup.cluster(docs, 4, 80).collect()} == {0}
    assert sum(seen) < 6 * len(texts)


def test_different_documents_around_one_passage(spark, monkeypatch):
    """They crowd the buckets of the passage; finer buckets leave the similar ones among them and make few pairs."""
    monkeypatch.setattr(minhash_dedup, "CROWD", 4)
    r = random.Random(21)
    passage = _prose(r, 40, "ijklmnop")
    texts = [f"{_prose(r, 12)} {passage} {_prose(r, 12)}" for _ in range(120)]
    texts += [" ".join([*t.split()[:-2], _prose(r, 2)]) for t in texts[::6]]
    seen = []
    verify = minhash_dedup._verify
    monkeypatch.setattr(minhash_dedup, "_verify", lambda edges, *a: seen.append(edges.count()) or verify(edges, *a))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert _sorted(minhash_dedup.cluster(docs, 4, 80).collect()) == _sorted(_groups(rows, 4, 80))
    assert sum(seen) < 12 * len(texts)


def test_only_pairs_that_may_be_similar_leave_the_buckets(spark, monkeypatch):
    """Different documents around one passage share buckets, but their sketches differ; only near copies become edges."""
    r = random.Random(41)
    passage = _prose(r, 40, "ijklmnop")
    texts = [f"{_prose(r, 12)} {passage} {_prose(r, 12)}" for _ in range(60)]
    texts += [" ".join([*t.split()[:-1], _prose(r, 1)]) for t in texts[::10]]
    seen = []
    verify = minhash_dedup._verify
    monkeypatch.setattr(minhash_dedup, "_verify", lambda edges, *a: seen.append(edges.count()) or verify(edges, *a))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert _sorted(minhash_dedup.cluster(docs, 4, 80).collect()) == _sorted(_groups(rows, 4, 80))
    assert sum(seen) == 6


def test_rounds_grow_with_the_logarithm_of_a_bucket(spark, monkeypatch):
    """A large group of copies in one bucket with many longer documents that are similar to none of them."""
    monkeypatch.setattr(minhash_dedup, "CROWD", 4)
    monkeypatch.setattr(minhash_dedup, "HUBS", 4)
    r = random.Random(31)
    base = _prose(r, 60).split()
    texts = [" ".join([*base[:i], _prose(r, 1), *base[i:]]) for i in range(60)]
    texts += [" ".join([*base, _prose(r, 22)]) for _ in range(60)]
    rounds = []
    verify = minhash_dedup._verify
    monkeypatch.setattr(minhash_dedup, "_verify", lambda *a: rounds.append(1) or verify(*a))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert _sorted(minhash_dedup.cluster(docs, 4, 80).collect()) == _sorted(_groups(rows, 4, 80))
    assert len(rounds) <= 6


def test_densified_signature():
    """A bin agrees as often as the sets are similar, for sets smaller and larger than the number of bins."""
    r = np.random.RandomState(3)
    for size in (6, 60, 600):
        agree = []
        for _ in range(300):
            grams = np.unique(r.randint(0, 1 << 63, size * 10 // 9, dtype=np.int64).astype(np.uint64) * np.uint64(2))
            cut = len(grams) // 10
            a, b = grams[cut:], grams[:len(grams) - cut]
            a, b = np.sort(r.permutation(grams)[cut:]), np.sort(r.permutation(grams)[cut:])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            agree.append((minhash_dedup.signature(a) == minhash_dedup.signature(b)).mean() - true)
        assert abs(np.mean(agree)) < 0.03


# Whitening

EMBEDDINGS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, x STRING, component INT"


def _whitened(vectors, k=4):
    """Expected n, deviations, |whitened| and explained by plain integers and numpy."""
    x = [[int(v) for v in np.floor(np.array(c, np.float32).astype(float) * 256)] for c in vectors]
    fit = sorted({tuple(v) for v in x})
    n, dims = len(fit), len(x[0])
    s = [sum(v[j] for v in fit) for j in range(dims)]
    v = np.array([[sum(n * f[i] * f[j] for f in fit) - s[i] * s[j] for j in range(dims)] for i in range(dims)], object)
    v = (v / (n * n)).astype(float)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    centred = [[n * a - b for a, b in zip(f, s)] for f in x]
    z = np.array([[a / n for a in c] for c in centred]) @ q / np.sqrt(e)
    return n, [sum(a * a for a in c) for c in centred], z, e / np.trace(v)


def _check(spark, vectors, ids=None, rows=()):
    ids = list(range(len(vectors))) if ids is None else ids
    data = [(i, [float(c) for c in v], 1, "clash", 9) for i, v in zip(ids, vectors)] + list(rows)
    out = whitening.whiten(spark.createDataFrame(data, EMBEDDINGS).repartition(3)).collect()
    n, deviation, z, explained = _whitened(vectors)
    assert len(out) == len(vectors) * z.shape[1]
    got = sorted((str(r.vec_id), r.n, r.deviation, r.component, round(abs(r.whitened), 6)) for r in out)
    assert got == sorted((str(i), n, d, c + 1, round(abs(w), 6)) for i, d, row in zip(ids, deviation, z) for c, w in enumerate(row))
    assert max(abs(r.explained / explained[r.component - 1] - 1) for r in out) < 1e-9
    assert {r.identity_error for r in out} == {out[0].identity_error} and out[0].identity_error < 1e-9


def test_whitening(spark):
    r = np.random.RandomState(1)
    vectors = (r.randn(300, 7) * [3, 1, 0.5, 2, 0, 0.01, 10]).round(3).tolist()
    _check(spark, vectors + vectors[:50] + [vectors[0]] * 40, rows=[
        (900, None, 1, "", 0), (901, [1.0] * 6 + [None], 1, "", 0), (902, [float("nan")] * 7, 1, "", 0), (903, [float("inf")] + [0.0] * 6, 1, "", 0),
        (904, [float("-inf")] * 7, 1, "", 0), (905, [], 1, "", 0), (906, [1.0, 2.0], 1, "", 0)])


def test_whitening_of_ids_and_far_values(spark):
    r = np.random.RandomState(2)
    vectors = r.randn(90, 5).tolist()
    _check(spark, vectors, ids=[None, 3, 3, *range(87)])
    vectors[7][2], vectors[8][2] = 3e12, -3e12
    data = [(i, [float(c) for c in v], 1, "", 0) for i, v in enumerate(vectors)]
    out = whitening.whiten(spark.createDataFrame(data, EMBEDDINGS)).collect()
    assert {r.deviation for r in out if r.vec_id in (7, 8)} == {None}  # beyond 64 bits
    _, deviation, z, _ = _whitened(vectors)
    assert all(abs(abs(r.whitened) - abs(z[r.vec_id][0])) < 1e-9 for r in out if r.component == 1)


def test_whitening_without_variance(spark):
    same = [(i, [1.0, 2.0], 1, "", 0) for i in range(5)]
    for rows in ([], same, [(1, None, 1, "", 0)], [(1, [], 1, "", 0)]):
        out = whitening.whiten(spark.createDataFrame(rows, EMBEDDINGS))
        assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    line = [(i, [float(i), 2.0 * i, 0.0], 1, "", 0) for i in range(5)]
    assert {r.component for r in whitening.whiten(spark.createDataFrame(line, EMBEDDINGS)).collect()} == {1}


def test_bit_planes():
    r = np.random.RandomState(4)
    x = r.randint(-700, 900, (whitening.BLOCK // 16 + 13, 6))
    x[:, 3] = 5
    spans = [(int(low), int(high)) for low, high in zip(x.min(axis=0), x.max(axis=0))]
    planes = whitening.Planes.of(spans)
    both = whitening.common_bits(planes.pack(x))
    u = x - x.min(axis=0)
    for i in range(6):
        for j in range(i, 6):
            p, q = np.ix_(planes.dim == i, planes.dim == j)
            weights = np.left_shift(1, planes.bit[p] + planes.bit[q])
            full = both + both.T - np.diag(np.diag(both))
            assert (full[p, q] * weights).sum() == (u[:, i] * u[:, j]).sum()


# Prefix trie

TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, depth STRING, parent INT"


def _trie(turns):
    """Expected nodes by walking every rebuilt conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, hashlib.md5(
                f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest(), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(rows)] for c, rows in own.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        head = c - (c % 5 if c >= 0 else -(-c % 5))
        paths[c] = tuple(own.get(head, [])[:h] + own[c][h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[:d - 1]].add(path[:d])
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in convs if paths[c] == node)))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, ())),
                    sum(m not in children for m in below), sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def _turns(convs, seed, deep=0):
    r = random.Random(seed)
    texts = ["", None, "hi", "é漢", "yes", "no", "x" * 50]
    out = []
    for c in range(convs):
        out += [(c, r.choice([t, None, 0]) if c % 11 == 3 else t, r.choice(["user", "user", "user", None]), texts[0 if r.random() < 0.4 else r.randint(0, 6)])
                for t in range(r.randint(1, 10))]
    out += [(-7, 1, "user", "yes"), (-5, 1, "user", "no"), (-5, 1, "user", "no"), (None, 1, "user", "lost"), (1 << 40, 5, "system", "far")]
    return out + [(convs + 3, t, "user", f"turn {t}") for t in range(deep)]


def _frame(spark, turns):
    return spark.createDataFrame([(*t, "clash", 0) for t in turns], TURNS).repartition(3)


@pytest.mark.parametrize("convs, deep, heavy, queue", [(20, 0, 32, 50_000), (260, 0, 32, 50_000), (260, 300, 2, 3), (120, 40, 0, 1)])
def test_prefix_trie(spark, monkeypatch, convs, deep, heavy, queue):
    monkeypatch.setattr(prefix_trie, "HEAVY", heavy)
    turns = _turns(convs, convs, deep)
    assert _sorted(prefix_trie.prefix_trie(_frame(spark, turns), queue).collect()) == _sorted(_trie(turns))


def test_one_conversation_many_times(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    turns = [(c, t, "user", f"t{t}") for c in range(400) for t in range(4)]
    assert _sorted(prefix_trie.prefix_trie(_frame(spark, turns)).collect()) == _sorted(_trie(turns))


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(_frame(spark, [(None, 1, "user", "x")])).collect() == []
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []


def test_spilling_queue():
    r = random.Random(8)
    queue, sent = prefix_trie.SpillingQueue(5), defaultdict(list)
    for i in range(500):
        key = (r.randint(0, 40), r.randint(0, 3))
        queue.push(key, (i,))
        sent[key].append((i,))
    assert 1 < len(queue.runs) <= prefix_trie.RUNS
    assert {key: sorted(queue.pop_all(key)) for key in sorted(sent)} == {key: sorted(v) for key, v in sent.items()}
    assert not queue.heap and not queue.runs
