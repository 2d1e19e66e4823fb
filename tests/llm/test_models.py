import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martlet.llm import language_id, lm_score, packing, quality, toxicity
from martlet.llm.queries import ORACLE, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_sql_queries(spark, key):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    frame = QUERIES[key](spark, SF)
    cols = sorted(frame.columns)
    res = con.execute(ORACLE[key])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted(tuple(r[names.index(c)] for c in cols) for r in res.fetchall())
    assert sorted(tuple(r[c] for c in cols) for r in frame.collect()) == want


def test_network_gradients_by_differences():
    net = language_id.Network(["a", "b"], seed=3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    data = np.frombuffer(b"the cat sat on a mat, der hund lief weg und", np.uint8)
    start, size, label = np.array([0, 11, 22]), np.array([9, 9, 9]), np.array([0, 1, 1])
    _, grad = net.gradients(data, start, size, label)
    for key, at in (("u", (0, 1, 2)), ("u", (1, 0, 20)), ("o", (1, 2, 1)), ("b", (0,)), ("x", (0, ord("t"), 5))):
        own, step = net.w[key][at], 1e-4
        losses = []
        for x in (own + step, own - step):
            net.w[key][at] = x
            losses.append(net.gradients(data, start, size, label)[0])
        net.w[key][at] = own
        assert abs((losses[0] - losses[1]) / (2 * step) - grad[key][at]) < 1e-4


def test_network_gradients_of_runs_of_several_lengths():
    net = language_id.Network(["a", "b"], seed=3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    data = np.frombuffer(b"the cat sat on a mat, der hund lief weg und", np.uint8)
    start, size, label = np.array([0, 11, 22]), np.array([4, 9, 1]), np.array([0, 1, 1])
    loss, grad = net.gradients(data, start, size, label)
    alone = [net.gradients(data, start[i:i + 1], size[i:i + 1], label[i:i + 1])[0] for i in range(3)]
    assert math.isclose(loss, np.average(alone, weights=size), rel_tol=1e-6)
    for key, at in (("u", (0, 1, 2)), ("u", (1, 0, 20)), ("o", (1, 2, 1)), ("b", (0,)), ("x", (0, ord("t"), 5)), ("x", (1, ord("d"), 9))):
        own, step = net.w[key][at], 1e-4
        losses = []
        for x in (own + step, own - step):
            net.w[key][at] = x
            losses.append(net.gradients(data, start, size, label)[0])
        net.w[key][at] = own
        assert abs((losses[0] - losses[1]) / (2 * step) - grad[key][at]) < 1e-4


def test_short_texts_alone_train_the_network():
    texts = ["the cat sat on it", "a dog and the hat"] * 20 + ["der hund lief weg", "und das ist gut"] * 20
    net = language_id.fit(texts, ["en"] * 40 + ["de"] * 40)
    p = net.predict(pa.array(["the hat and a cat", "das ist der hund"], pa.string()))
    assert [net.languages[k] for k in p.argmax(axis=1)] == ["en", "de"] and p.max(axis=1).min() > 0.8


def test_languages_beyond_the_64th_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(language_id, "EPOCHS", 0)
    made = [(100 * k + i, "some text", f"l{k:02}") for k in range(70) for i in range(2 - (k == 69))]
    net = language_id.train(spark.createDataFrame([*made, (9000, "", "none"), (9001, "x", None)], "doc_id long, text string, lang string"))
    assert net.languages == [f"l{k:02}" for k in range(70)]


def test_language_id_held_out(spark, docs, empty):
    rows = QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = rows.filter("held_out").join(lang, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    net = language_id.train(docs)
    got = {r.doc_id: r for r in language_id.identify(docs, net).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (0, 1, 2)) and 0 < got[42].score <= 1
    assert language_id.identify(empty, language_id.train(empty)).count() == 0


def test_toxicity_held_out(spark, docs, empty):
    made = [(i, ("mild grey fog over hills " * 20 + ("vileword" + "xyz"[i % 3] if i % 4 == 0 else "") + " calm"), int(i % 4 == 0)) for i in range(240)]
    rows = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    model = toxicity.train(rows.select("doc_id", "text"), rows.filter("doc_id < 160").select("doc_id", "toxic"))
    long = spark.createDataFrame([(1, "w" * 40_000), (2, "é" * 16_384), (3, None), (4, "")], "doc_id long, text string")
    drawn = toxicity.sample(long, spark.createDataFrame([(i, i % 2) for i in range(1, 5)], "doc_id long, toxic int"), 9).collect()
    assert {r.doc_id: len(r.text or "") for r in drawn} == {1: 16_384, 2: 16_384, 3: 0, 4: 0}
    told = {r.doc_id: r.score for r in toxicity.score(rows.drop("toxic"), model).collect()}
    assert all((told[i] >= 0.5) == bool(y) for i, _, y in made if i >= 160)
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(empty, toxicity.train(empty, rows.limit(0))).count() == 0


def test_lm_base_score_and_normalisation(docs, texts, empty):
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    tokens = {i: [*WORD.findall((t or "").translate(fold)), "\n"] for i, t in texts}
    train = [i for i in tokens if i % 2]
    count = collections.Counter(w for i in train for w in tokens[i])
    total, distinct = sum(count.values()), len(count)
    got = {r.doc_id: r for r in lm_score.score(docs, docs.filter("doc_id % 2 = 1")).collect()}
    for i, own in tokens.items():
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9) and got[i].train_tokens == total
        assert (got[i].n_tokens, got[i].n_known) == (len(own), sum(count[w] > 0 for w in own)) and got[i].score < 0
    assert lm_score.score(empty, empty).count() == 0


def test_lm_gates_are_fitted_on_every_choice(spark, monkeypatch):
    rows = [(i, None if i == 7 else f"Same same w{i % 90} {'rare' * (i % 3)}{i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counted = lm_score.word_counts(docs).unionAll(spark.createDataFrame([("\n", lm_score.END_HASH, 900)], "word string, hash long, n long")).cache()
    want = collections.Counter(w for _, t in rows for w in WORD.findall((t or "").lower()))
    assert {r.word: r.n for r in counted.collect()} == want | {"\n": 900}
    seen, fit = {}, lm_score._fit_gates
    monkeypatch.setattr(lm_score, "_fit_gates", lambda cell, n: seen.update(zip(cell.tolist(), n.tolist())) or fit(cell, n))
    codes, _, _ = lm_score.train(docs, counted, 900 + want.total())
    symbols, letters = codes.value
    choices = 0
    for _, t in rows:
        data, off = lm_score.W.utf8(pa.array([t], pa.string()))
        ws, we, first = lm_score.W.word_spans(data, off)
        symbol, _, _ = symbols.read(lm_score.W.word_hashes(data, ws, we, fold=True).view(np.int64), first)
        spelt = np.flatnonzero(symbol == symbols.escape)
        choices += int(np.diff(symbols.code.first)[symbol].sum()) + len(lm_score._letters(letters, data, ws[spelt], we[spelt])[2])
    assert sum(seen.values()) == choices


def test_lm_gates_code_their_choices_best():
    rnd = np.random.default_rng(3)
    level = rnd.integers(0, 64, (400, 2))
    x = np.column_stack([(level + 0.5) * (2 * lm_score.BOUND / 64) - lm_score.BOUND, np.zeros(400), np.ones(400)])
    n = np.rint(1e6 / (1 + np.exp(-x @ [0.3, 0.9, 0, -0.2]))).astype(np.int64)
    place = 5 * lm_score.CELLS + level[:, 0] * 64 + level[:, 1]
    gates = lm_score._fit_gates(np.concatenate([place * 2 + 1, place * 2]), np.concatenate([n, 1_000_000 - n]))
    assert np.allclose(gates[5], [0.3, 0.9, 0.5, -0.2], atol=1e-3) and (gates[[0, 1, -1]] == [0.5, 0.5, 0.5, 0]).all()
    assert (lm_score._fit_gates(np.zeros(0, np.int64), np.zeros(0, np.int64)) == [0.5, 0.5, 0.5, 0]).all()


def test_code_paths_cover_all_symbols():
    code = lm_score.Code(np.array([5, 1, 1, 9]))
    assert math.isclose(sum(2.0 ** -(code.first[s + 1] - code.first[s]) for s in range(4)), 1)


def test_packing_round_trip(docs, texts, empty):
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, length=64).collect()
    ids = {i: np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in texts}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert sum(r.length for r in rows) == sum(map(len, ids.values())) + len(ids[texts[6][0]])
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for s, own in by.items():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and (ends[-1] == 64 or s == max(by))
    assert packing.pack(empty, path).count() == 0


def test_ranges_hold_tokens_alike(spark):
    rnd = random.Random(3)
    same = "one text that a third of all rows has " * 5
    rows = [(i, same if i % 3 == 0 else " ".join(f"w{rnd.randint(0, 900)}" for _ in range(rnd.choice([3, 30, 2000 if i % 50 == 1 else 60])))) for i in range(3000)]
    coded = (spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
             .mapInArrow(packing._tokenise(tokenizer_path("byte_bpe_50k.json")), "doc_id long, key long, doc_tokens long, ids binary")
             .withColumn("tie", F.xxhash64("doc_id", "ids")).cache())
    total = coded.agg(F.sum("doc_tokens")).first()[0]
    ranged, count = packing._ranged(coded, packing._cuts(coded, total, 40))
    got = ranged.select("range", "key", "tie", "doc_tokens").orderBy("key", "tie").collect()
    assert len(got) == 3000 and [r.range for r in got] == sorted(r.range for r in got) and got[-1].range < count <= 81
    held = collections.Counter()
    for r in got:
        held[r.range] += r.doc_tokens
    assert max(held.values()) < 2 * total / 40 + max(r.doc_tokens for r in got)
    copies = next(r.key for r in coded.filter("doc_id = 0").collect())
    assert len({r.range for r in got if r.key == copies}) > 3
    coded.unpersist()


def test_sequences_follow_the_curve(spark, docs):
    path = tokenizer_path("byte_bpe_50k.json")
    coded = docs.select("doc_id", "text").mapInArrow(packing._tokenise(path), "doc_id long, key long, doc_tokens long, ids binary")
    keys = {r.doc_id: r.key for r in coded.select("doc_id", "key").collect()}
    rows = sorted(packing.pack(docs, path, length=64).collect(), key=lambda r: (r.sequence_id, r.offset))
    line = [keys[r.doc_id] for r in rows]
    assert line == sorted(line) and len(set(line)) > 20


def test_pieces_of_one_hash(monkeypatch):
    path = tokenizer_path("byte_bpe_50k.json")
    texts = [" ".join(f"word{i * j % 17} und {j}" for j in range(30)) for i in range(20)] + [None, "", "word1", " word1"]
    want = packing._Encoder(path).encode(texts)
    plain = packing.W.word_hashes
    monkeypatch.setattr(packing.W, "word_hashes", lambda *a, **k: plain(*a, **k) % np.uint64(5))
    one = packing._Encoder(path)
    assert one.encode(texts) == want and one.encode(texts) == want


def test_pieces_equal_whole_texts():
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    plain, own = Tokenizer.from_file(path), packing._Encoder(path)
    odd = ["a  b", "a   b", " a", "a ", "\n \nx", "x\n y", "x \ny", "it's I'll", "", "<|endoftext|> a <|endoftext|>b", "a  b", "\t a", " ", "é à  ü", "1 22 $$ a\0b", "  x"]
    assert own.encode(odd) == [np.array(plain.encode(x, add_special_tokens=False).ids, "<u2").tobytes() for x in odd]


def test_hilbert_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = packing.hilbert_key(grid, 3)
    assert sorted(key) == list(range(512)) and (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_quality_counts_against_brute_force(docs, texts, empty):
    got = {r.doc_id: r for r in quality.assess(docs).collect()}
    for i, t in texts:
        w, t = WORD.findall(t or ""), t or ""
        seen = collections.Counter(tuple(w[j:j + 8]) for j in range(len(w) - 7))
        covered = {p for j in range(len(w) - 7) if seen[tuple(w[j:j + 8])] > 1 for p in range(j, j + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and 0 <= r.word_distance <= 1
    assert quality.assess(empty).count() == 0


def test_quality_verdicts_on_texts_of_the_wrong_language(spark):
    rnd = random.Random(5)

    def text(lang, n):
        return " ".join(f"{lang}{rnd.randint(1, 60)}" if rnd.random() < 0.3 else "".join(rnd.choice("abcdefghij") for _ in range(7)) for _ in range(n))

    sizes = (25, 40, 80, 150, 400, 2000)
    rows = [(i, text("ab"[i % 2], rnd.choice(sizes)), "ab"[i % 2]) for i in range(600)]
    rows += [(1000 + 10 * k + j, text("ab"[j % 2], n), "ba"[j % 2]) for k, n in enumerate(sizes) for j in range(2)]
    rows.append((2000, " ".join([f"a{i}" for i in range(1, 13)] + ["#" * i for i in range(5, 23)]), "a"))
    got = {r.doc_id: r for r in quality.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert sum(got[i].kept for i in range(600)) >= 594
    assert [i for i, r in got.items() if i >= 1000 and r.kept] == []
    assert got[2000].n_words == 30 and got[2000].char_distance > 0.25


def test_quality_of_rare_languages_and_brute_force_distances(spark):
    rnd = random.Random(8)
    common = {x: [f"{x}{i}" for i in range(60)] for x in ("aa", "bb", "cc", "dd")}

    def text(x, n=150):
        return " ".join(rnd.choice(common[x][:40]) if rnd.random() < 0.3 else "".join(rnd.choice("abcdefghij") for _ in range(7)) for _ in range(n))

    rows = [(i, text("aa"), "aa") for i in range(3000)] + [(10_000 + i, text(x), x) for x in ("bb", "cc") for i in range(12)]     # 12 of 3,000: far under one in 200
    rows += [(20_000, text("aa"), "bb"), (20_001, text("bb"), "aa"), (20_002, text("dd"), "dd"), (20_003, text("dd"), None), (20_004, text("bb"), "cc")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r.doc_id: r for r in quality.assess(frame).collect()}
    assert all(r.kept for i, r in got.items() if 10_000 <= i < 20_000)
    assert sum(r.kept for i, r in got.items() if i < 10_000) >= 2990
    assert [got[20_000 + k].kept for k in range(5)] == [False, False, True, True, False]      # one text of dd, and no language: not judged by words
    assert got[20_002].word_distance == got[20_003].word_distance == got[20_003].char_distance == 0

    def js(p, q):
        m = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in {*p, *q}}
        kl = lambda x: sum(v * math.log2(v / m[k]) for k, v in x.items() if v > 0)
        return math.sqrt(max(0.0, (kl(p) + kl(q)) / 2))

    def shares(counts, names):
        total = sum(counts.values())
        out = {k: counts[k] / total for k in names}
        return out | {None: max(0.0, 1 - sum(out.values()))}

    for x in ("aa", "bb"):
        counts = collections.Counter(w for _, t, lang in rows if lang == x for w in t.split(" "))
        names = sorted(counts, key=lambda w: (-counts[w], w))[:50]
        for i, t, lang in rows[::97] + rows[-10:]:
            if lang == x:
                assert abs(got[i].word_distance - js(shares(collections.Counter(t.split(" ")), names), shares(counts, names))) < 1e-6
    salted = {r.doc_id: r for r in quality.assess(frame, small=1).collect()}                  # references joined instead of broadcast
    assert salted.keys() == got.keys() and all(salted[i].kept == r.kept and abs(salted[i].word_distance - r.word_distance) < 1e-9 for i, r in got.items())


def test_word_hashes_are_split_like_the_pattern(texts):
    from martlet.llm import words as W
    data, off = W.utf8(pa.array([t for _, t in texts], pa.string()))
    ws, we, first = W.word_spans(data, off)
    assert [data[a:b].tobytes().decode() for a, b in zip(ws, we)] == [x for _, t in texts for x in WORD.findall(t or "")]
    assert np.diff(first).tolist() == [len(WORD.findall(t or "")) for _, t in texts]
