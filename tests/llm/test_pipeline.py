import random
import re
import zlib

import numpy as np

import corpus_pipeline as C
from martlet.llm import decontaminate, near_dedup
from martlet.llm.queries import tokenizer_path
from martlet.llm.tables import store


def test_stages_in_turn(spark, docs, texts, tmp_path):
    items = spark.createDataFrame([(1, " ".join(texts[-1][1].split()[5:25])), (2, None), (3, "zzz qqq")], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    frame, kept = docs, {}
    for name, stage in C.STAGES:
        frame = store(stage(spark, frame, str(tmp_path)), "test-stage")
        if name != "packing":
            assert frame.columns == docs.columns
        kept[name] = {r.doc_id for r in frame.select("doc_id").collect()}
    assert not kept["language_id"] & {0, 1, 2}
    assert kept["near_dedup"] <= kept["line_dedup"] <= kept["language_id"]
    assert len(kept["near_dedup"] & {10, 11, 12, 13, 20, 21, 22, 23}) >= 1
    assert kept["near_dedup"] - kept["decontamination"] == {texts[-1][0]}
    assert kept["packing"] == kept["decontamination"]


def test_contamination_with_short_items_and_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([(1, "ONE, two"), (2, ""), (None, "same same")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.contamination(docs, items).collect()}
    assert got[3] == got[4] == got[5] == (2, 1) and got[40] == (600, 1) and got[0] == (0, 0)
    assert decontaminate.contamination(empty, items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).filter("contaminated").count() == 0


def test_short_items_of_all_lengths_are_found_in_one_pass(spark):
    w = [f"w{k}" for k in range(30)]
    items = [(n, " ".join(w[n:2 * n])) for n in range(1, 13)] + [(20, "W1"), (21, "absent here"), (22, None)]
    text = {1: " ".join(w), 2: "w1 w1 x w2, w3", 3: "w9", 4: None}
    docs = spark.createDataFrame(list(text.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for i, t in text.items():
        words, hit, found = (t or "").replace(",", "").split(), set(), set()
        for n, item in items:
            own = (item or "").lower().split()
            size = min(10, len(own))
            for j in range(len(own) - size + 1):
                for at in range(len(words) - size + 1):
                    if size and words[at:at + size] == own[j:j + size]:
                        hit.update(range(at, at + size)), found.add(n)
        want[i] = (len(hit), len(found))
    assert got == want and want[1][1] == 13


def test_near_copies_between_80_and_85_percent_go(spark):
    plain = [f"w{i}" for i in range(200)]
    near, far = plain.copy(), plain.copy()
    for k in range(4):                                 # 176 of 216 shingles are shared: 81.5 %
        near[20 + 40 * k] = "x"
    for k in range(5):                                 # 171 of 221: 77.4 %
        far[20 + 40 * k - (k == 4) * 10] = f"y{k}"
    pair = spark.createDataFrame([(1, " ".join(plain)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")
    assert {r.doc_id for r in C.drop_near_duplicates(spark, pair, "").collect()} == {1, 3}
    assert near_dedup.near_duplicates(pair).filter("kept").count() == 3


def test_long_passages_of_one_or_two_lines_go(spark):
    long, a, b, short = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("l", 50), ("a", 20), ("b", 30), ("s", 49)))
    rows = [(1, f"{long}\nx\n{a}\n{b}\n{short}"), (2, f"y\n{long}"), (3, f"{a}\n \n{b}\nz"), (4, f"{short}\nq"), (5, f"{long}\n{long}"), (6, f"{b}\n{a}")]
    frame = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in C.drop_lines(spark, frame, "").collect()}
    want = {1: rows[0][1], 2: "y", 3: " \nz", 4: rows[3][1], 6: rows[5][1]}
    assert got == {i: (t, len(t)) for i, t in want.items()}


BLANK, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def test_lines_move_the_texts_once(spark):
    frame = spark.createDataFrame([(i, f"w{i} a\n\nb", "en", "s", 7, i) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long, rest long")
    got = C.drop_lines(spark, frame, "")
    assert got.columns == frame.columns and {tuple(r) for r in got.collect()} == {tuple(r) for r in frame.collect()}
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    told = C.drop_lines(spark, frame, "")._jdf.queryExecution().explainString(mode)
    moved = [x for x in told.split("\n\n") if re.match(r"\s*\(\d+\) Exchange", x) and re.search(r"Input \[\d+\]: .*(text|_[0-9a-f]{32})#", x)]
    assert len(moved) == 1, moved


def plain_lines(rows):
    """Later runs of three worded lines, or of one or two with 50 words, by trying all; rows come in order of their ids."""
    out, seen = [], set()
    for i, text in rows:
        lines = text.split("\n")
        at = [k for k, x in enumerate(lines) if BLANK.search(x)]
        gone = set()
        for size in (1, 2, 3):
            for j in range(len(at) - size + 1):
                run = tuple(lines[k] for k in at[j:j + size])
                if size == 3 or sum(len(BLANK.findall(x)) for x in run) >= 50:
                    if run in seen:
                        gone.update(at[j:j + size])
                    seen.add(run)
        if len(gone) < len(at) or not at:
            out.append((i, "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return out


def plain_near(rows):
    sets, keep = [], []
    for _, text in rows:
        w = BLANK.findall(text.lower())
        sets.append({tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return [row for k, row in enumerate(rows) if root[k] == k]


def plain_clean(rows, items):
    grams = set()
    for t in items:
        w = ALNUM.findall((t or "").lower())
        grams.update(tuple(w[j:j + 10]) for j in range(max(1, len(w) - 9)) if w)
    sizes = {len(g) for g in grams}

    def hit(text):
        w = ALNUM.findall(text.lower())
        return any(tuple(w[j:j + n]) in grams for n in sizes for j in range(len(w) - n + 1))
    return [(i, t) for i, t in rows if not hit(t)]


def test_run_against_plain_stages(spark, texts, tmp_path):
    """All rows of ``run``: without labels every text with a letter passes language ID; rows without id, and two texts of one id, are there."""
    from tokenizers import Tokenizer
    rnd = random.Random(4)
    rows = [(i, t) for i, t in texts if i is not None]
    item = " ".join(texts[-2][1].split()[3:25])
    rows += [(None, f"{texts[-2][1]} again"), (None, texts[6][1]), (30, "another text of the id thirty, with words of its own"), (70, "12 34 56"), (71, "\n".join(["a b c", "d e f", "g h i", "only here"])),
             (71, "\n".join(["a b c", "d e f", "g h i"])), (72, " ".join(rnd.choice("pqrst") * 3 for _ in range(90)))]
    frame = spark.createDataFrame([(i, t, None, "s", len(t or ""), "k", "t") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, _key string, _text string")
    frame.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    hashed = {t: spark_hash for t, spark_hash in frame.selectExpr("text", "xxhash64(text) as h").collect()}
    left = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    left.sort(key=lambda r: (r[0] is None, r[0] or 0, hashed[r[1]]))
    left = plain_lines(left)
    left = plain_near(left)
    left = plain_clean(left, [item])
    assert len(left) < len(rows) - 10 and None not in {i for i, _ in left}
    got = C.run(spark, str(tmp_path)).collect()
    tokenizer, want = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json")), []
    for i, t in left:
        want.append((i, [*tokenizer.encode(t, add_special_tokens=False).ids, 1]))
    pieces = {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    assert sorted(pieces) == sorted((i, len(ids)) for i, ids in want)
    for i, ids in want:
        for start, length, crc in pieces[i, len(ids)]:
            assert zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes()) == crc
        assert sum(n for _, n, _ in pieces[i, len(ids)]) == len(ids)
