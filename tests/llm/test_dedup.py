import hashlib
import math
import random
import re

import numpy as np
import pytest

from martlet.llm import line_dedup, near_dedup, sharding, substring_dedup
from martlet.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def test_substring_against_brute_force(docs, texts, empty):
    first = {}
    lists = {i: WORD.findall(t or "") for i, t in texts}
    for i in sorted(lists):
        for j in range(len(lists[i]) - 49):
            first.setdefault(tuple(lists[i][j:j + 50]), i)
    want = {}
    for i, w in lists.items():
        gone = set()
        for j in range(len(w) - 49):
            if first[tuple(w[j:j + 50])] < i:
                gone.update(range(j, j + 50))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = substring_dedup.remove_repeats(docs, digest=True).collect()
    assert len(got) == len(texts) + 1
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == want
    assert sum(n > 0 for _, n, _ in want.values()) >= 8
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_every_window_has_its_least_gram_among_few_fingerprints():
    rnd, window, k = np.random.default_rng(1), 50, 25
    texts = [np.full(700, 5), np.tile([3, 9], 300), np.tile(np.arange(7), 60), rnd.integers(0, 3, 500), rnd.integers(0, 900, 800), np.full(49, 5), np.full(50, 5)]
    texts.append(np.concatenate([np.full(90, 5), rnd.integers(0, 900, 40), np.full(200, 5)]))
    h = substring_dedup.W.mix(np.concatenate(texts).astype(np.uint64) + np.uint64(1))
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    at, value = substring_dedup.fingerprints(h, first, window)
    g, chosen = substring_dedup.W.grams(h, k), dict(zip(at.tolist(), value.tolist()))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        for s in range(a, b - window + 1):
            least = g[s:s + window - k + 1].min()
            assert any(chosen.get(p) == least for p in range(s, s + window - k + 1))
    assert sum(p < 700 for p in chosen) < 60


def test_automaton_decides_what_is_removed():
    h = substring_dedup.W.mix(np.arange(1, 301, dtype=np.uint64))
    shard, empty = substring_dedup._Shard(), substring_dedup._Shard()
    shard.add(3, h[100:160])
    assert np.flatnonzero(shard.covered(9, h)).tolist() == list(range(100, 160))
    assert not shard.covered(3, h).any() and not shard.covered(2, h).any()
    assert not empty.covered(9, h).any()
    near = h.copy()
    near[130] ^= np.uint64(1 << 40)                    # another word with the same symbols
    assert not shard.covered(9, near).any()
    shard = substring_dedup._Shard()
    shard.add(3, near[100:160]), shard.add(4, h[100:160])
    assert shard.covered(9, h).sum() == shard.covered(9, near).sum() == 60
    assert not shard.covered(4, h).any() and shard.covered(4, near).sum() == 60


def test_substring_texts_of_one_id_are_judged_each_by_its_own(spark):
    rnd = random.Random(4)
    one, two = (" ".join(str(rnd.random()) for _ in range(n)) for n in (60, 300))
    rows = [(1, one), (2, one), (2, two), (2, two), (3, "x " + two), (None, two), (3, None)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), digest=True).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == [(0, 300, 0), (1, 60, 0), (2, 60, 60), (2, 300, 0), (2, 300, 0), (3, 0, 0), (3, 301, 300)]


def test_a_common_phrase_does_not_send_passages_everywhere(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD", 200)
    rnd = random.Random(5)
    phrase = " ".join(f"p{i}" for i in range(40))
    sent = []
    for n in (150, 300):
        rows = []
        for i in range(n):
            left, right = (" ".join(str(rnd.random()) for _ in range(12)) for _ in range(2))
            rows += [(2 * i + j, f"{rnd.random()} {left} {phrase} {right} {rnd.random()}") for j in range(2)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        sent.append(substring_dedup.deal(df, 50).passages.count())
        assert {r.n_removed for r in substring_dedup.remove_repeats(df).filter("doc_id % 2 = 1").collect()} == {64}
    assert sent[0] <= 2 * 150 and sent[1] <= 2 * 300


def test_near_duplicates_against_brute_force(docs, texts, empty):
    sets = {}
    for i, t in texts:
        w = WORD.findall((t or "").translate(FOLD))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(texts) + 1
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}
    assert near_dedup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("near, stated", [(0.85, "3e-6"), (0.8, "2e-5")])
def test_stated_loss_covers_banding_and_signature_tests(near, stated):
    def under(cut, n):                                 # bytes of unequal minima agree by chance, too
        p = near + (1 - near) / 256
        return sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(n) if k / n < cut)
    minima = near_dedup.BANDS * near_dedup.ROWS
    lost = (1 - near ** near_dedup.ROWS) ** near_dedup.BANDS + under(near - near_dedup.SLACK, minima) + under(near - near_dedup.WIDE_SLACK, near_dedup.WIDE)
    assert lost < float(stated) and stated in near_dedup.__doc__.split("together")[-1]


def test_components_of_a_long_path(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)], "u long, v long")
    got = {r.node: r.component for r in components(path).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_null_ids_and_null_texts(spark):
    odd = spark.createDataFrame([(None, "a b c d e f"), (None, None), (1, "a b c d e f"), (2, None)], "doc_id long, text string")
    near = {(r.doc_id, r.kept) for r in near_dedup.near_duplicates(odd).collect()}
    assert near == {(None, True), (1, True), (2, True)}
    assert {r.n_removed for r in substring_dedup.remove_repeats(odd).collect()} == {0}
    assert {r.text for r in line_dedup.remove_runs(odd).collect()} == {"a b c d e f", None}


def test_lines_against_brute_force(docs, texts, empty):
    seen, want = set(), {}
    for i, t in sorted(texts):
        lines = (t or "").split("\n")
        worded = [j for j, x in enumerate(lines) if WORD.search(x)]
        gone = set()
        for k in range(len(worded) - 2):
            key = tuple(lines[j] for j in worded[k:k + 3])
            if key in seen:
                gone.update(worded[k:k + 3])
            seen.add(key)
        want[i] = (len(worded), len(gone), t if not gone else "\n".join(x for j, x in enumerate(lines) if j not in gone))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup.remove_runs(docs).collect()}
    assert got == want and want[51][1] == 5 and want[52][1] == 6
    assert line_dedup.remove_runs(empty).count() == 0


@pytest.mark.parametrize("shards", [1, 7, 24])
def test_ring_against_row_by_row_rounds(docs, shards):
    rows = sharding.assign(docs, shards, vnodes=8).collect()
    counts = [sum(r.shard == s for r in rows) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_rounds_on_counts_equal_rounds_on_rows():
    counts, owners, shards = [5, 0, 9, 2, 7, 1], [0, 1, 2, 0, 1, 2], 3
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    waiting = {a: list(range(n)) for a, n in enumerate(counts)}
    want, hop = {}, 0
    while any(waiting.values()):
        for point in range(len(owners)):
            arc = (point - hop) % len(owners)
            for row in list(waiting[arc]):
                if room[owners[point]]:
                    room[owners[point]] -= 1
                    want[arc, row] = owners[point]
                    waiting[arc].remove(row)
        hop += 1
    got = {(a, r): s for a, cuts in enumerate(sharding.play(counts, owners, shards)) for lo, hi, s in cuts for r in range(lo, hi)}
    assert got == want


def test_sharding_empty(empty):
    assert sharding.assign(empty, 5).count() == 0


def test_one_more_shard_moves_few_rows(spark):
    """24 to 25 shards: rows with and without id move by about a shard's share, and by what bounded loads pass on."""
    frame = spark.createDataFrame([(i if i % 2 else None, f"text {i}") for i in range(4000)], "doc_id long, text string")
    def homes(n):
        return {(r.doc_id, r.text_crc32): (r.home_shard, r.shard) for r in sharding.assign(frame, n).collect()}
    a, b = homes(24), homes(25)
    for known in (True, False):
        rows = [k for k in a if (k[0] is not None) == known]
        assert {b[k][0] for k in rows if a[k][0] != b[k][0]} == {24}        # homes change to the new shard only
        assert sum(a[k][0] != b[k][0] for k in rows) < 0.06 * len(rows)
        assert sum(a[k][1] != b[k][1] for k in rows) < 0.25 * len(rows)
