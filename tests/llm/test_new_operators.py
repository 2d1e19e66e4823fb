import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from martlet.llm import conversations, periodic, queries, url_filter

SOLID = re.compile(r"[^\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LEGAL, BEGUN = re.compile(r"(s?(ua)+)?\Z"), re.compile(r"s?(ua)*u?\Z")


def cheapest(rows):
    """(cost, audit, text) of the cheapest edits of [(role, text, fault)], by trying all that can still become legal."""
    best, most = None, 4 * len(rows)                  # deleting all rows costs that much

    def go(i, cost, audit, out, inserted):
        nonlocal best
        if cost > (most if best is None else best[0]) or not BEGUN.match("".join(r[:1] or "-" for r, _ in out)):
            return
        if i == len(rows) and LEGAL.match("".join(r[:1] for r, _ in out)):
            found = (cost, audit, "\n".join(f"{r}:{t}" for r, t in out))
            best = found if best is None else min(best, found)
        if inserted < 2:
            for r in ("user", "assistant"):
                go(i, cost + 3, audit + "I", [*out, (r, "")], inserted + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            go(i + 1, cost + 4, audit + "D", out, 0)
            if fault in ("", "truncated"):
                more = 3 * (fault == "truncated")
                go(i + 1, cost + more, audit + "K", [*out, (role, text)], 0)
                for r in ("user", "assistant"):
                    go(i + 1, cost + 3 + more, audit + "R", [*out, (r, text)], 0)

    go(0, 0, "", [], 0)
    return best


def plain_conversations(rows):
    """The whole contract, row by row: {conv_id: columns}."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            role, text = (" " if v is None else v for v in (role, text))
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 1:
                text = ""
            if kind == 2:
                text = re.sub("[.!?]", "", text)
            if kind == 4:
                role = "user"
            kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faulty = set(), []
        for turn, role, text in kept:
            solid = SOLID.findall(text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = {t for t, _, _ in kept if t is not None}
        initials = [r[:1] for _, r, _ in kept]
        cost, audit, text = cheapest(faulty)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[sum(f == k for _, _, f in faulty) for k in ("blank", "duplicate", "truncated")],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def turns():
    rnd = random.Random(5)
    rows = []
    for conv in range(220):
        n = rnd.randint(1, 5)
        for turn in range(n):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rnd.choice(["Good.", "Well?", "so what", " \n", None, "Done! ", "é…", f"{conv} {turn}."])
            rows.append((conv, turn + (turn > 2) * rnd.randint(0, 3), role, text))
    rows += [(None, 1, "user", "a."), (None, None, "assistant", "b."), (None, None, "assistant", "b."), (900, None, "user", "x"), (901, 5, "user", "q?"), (901, 5, "assistant", "r.")]
    drop = next(c for c in range(10_000, 20_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (drop, 0, "user", "gone.")]


CONV = "conv_id long, turn long, role string, text string, fault string, at int, digest string, of long, told string, kind int, copy int"


def as_rows(frame):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in frame.collect()}


def test_conversations_against_all_edits(spark, turns):
    frame = spark.createDataFrame([(*r, "f", 1, "d", 2, "t", 3, 4) for r in turns], CONV).repartition(5)
    want = plain_conversations(turns)
    got = conversations.repair(conversations.damage(frame))
    assert as_rows(got) == want and got.count() == len(want)
    assert any(v[5:] == (0, "", hashlib.sha256(b"").hexdigest()) for v in want.values())
    assert conversations.repair(conversations.damage(frame.limit(0))).count() == 0


def test_blocks_don_t_change_a_long_conversation(monkeypatch):
    rnd = random.Random(3)
    rows = [(rnd.choice("suauaua"), rnd.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(900)]

    def edits(size):
        monkeypatch.setattr(conversations, "BLOCK_ROWS", size)
        out, pending = [], []
        path = conversations.Repair(lambda row, letters: out.append((row, letters)))
        for i, (initial, fault) in enumerate(rows):
            path.add(i, initial, fault)
            pending.append(sum(len(r) for r, _ in path.open))
        return path.end(), out, max(pending)

    whole, small = edits(10_000), edits(7)
    assert whole[:2] == small[:2] and [r for r, _ in small[1]] == [*range(900), None]
    assert small[2] < 100                             # decided blocks are given out at once
    assert edits(1)[:2] == whole[:2]


def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_periodic(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    told = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], hashlib.sha256(told.encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def periodic_texts():
    rnd = random.Random(9)

    def word():
        return "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 4)))
    rows = [(0, None), (1, ""), (2, " \t"), (3, "x"), (4, "a a a a a"), (5, "a a a a a a"), (6, "ab ab " * 400)]
    for i in range(150):
        w = [word() for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            unit = [rnd.choice("xyz") if rnd.random() < 0.7 else word() for _ in range(rnd.choice([1, 2, 3, 7, 15, 16, 17, 31, 32, 33, 40, 63, 64, 65, 100]))]
            n = rnd.randint(3 * len(unit), 6 * len(unit))
            w += (unit * 7)[:n] + [word() for _ in range(rnd.randint(0, 20))]
        rows.append((10 + i, rnd.choice([" ", "\n ", "\t"]).join(w)))
    fib, tm = ["a", "ab"], "a"
    for _ in range(12):
        fib.append(fib[-1] + fib[-2])
        tm += "".join("b" if c == "a" else "a" for c in tm)
    return [*rows, (200, " ".join(fib[-1])), (201, " ".join(tm)), (202, " ".join(tm[:100] * 5)), (203, " ".join("aab" * 30 + "ab" * 30 + "aab" * 30)), (None, "q q q q q q")]


def test_periodic_runs_against_brute_force(spark):
    rows = periodic_texts()
    rows += [(i, " ".join(f"w{j}" for j in range(i % 90))) for i in range(1000, 1200)]
    frame = spark.createDataFrame([(i, t, 1, "r") for i, t in [*rows, rows[6]]], "doc_id long, text string, n_runs int, number string").repartition(4)
    from pyspark.sql import functions as F
    frame = frame.withColumn("crc", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    got = periodic.periodic_runs(frame, "crc", digest=True)
    want = {i: plain_periodic(i, t) for i, t in rows}
    assert {r.doc_id: tuple(r)[2:] for r in got.collect()} == want and got.count() == len(rows) + 1
    assert sum(v[0] for v in want.values()) > 100 and max(v[3] or 0 for v in want.values()) >= 64
    assert {r.doc_id: r.collapsed for r in periodic.periodic_runs(frame).collect()}[6] == "ab"
    assert periodic.periodic_runs(frame.limit(0)).count() == 0


def test_seeds_find_every_long_run_by_themselves():
    rnd = np.random.default_rng(2)
    for q in [*range(16, 70), 127, 128, 129, 200]:
        unit, noise = rnd.integers(0, 3, q).astype(np.uint64), rnd.integers(10, 2**60, 40).astype(np.uint64)
        x = np.concatenate([noise, np.tile(unit, 5)[:4 * q], noise[::-1]])
        x = periodic.mix(x)
        w = x.tolist()
        assert [(s, e - s, p) for s, e, p in periodic.runs(x, len(x)).tolist()] == plain_runs(w)


def test_urls_against_row_by_row_rules(spark):
    urls = [None, "", "no scheme/x", "http://", "https://ORG", "http://org/", "http://a.org/x#y", "http://xorg/", "http://EXAMPLE.org/es/a?b", "http://m.example.org/en/12", "http://m.example.org/en/2",
            "http://a.b.com/fr/", "http://com/de/#", "http://x.com/fr", "http://x.com/FR/", "ftp://u:p@x.com:80/de/", "http://a..org/z", "://org/q", "http://x.com?/de/", "http://x.com#://org/", "http://É.com/de/" + "z" * 5000, "a://b://org/"]
    pages = [(i if i != 3 else None, u) for i, u in enumerate(urls)] * 2 + [(100 + i, f"http://h{i}.com/de/{i}") for i in range(50)]
    more = [*url_filter.FIXED_RULES, ("org", "/", "block"), (None, "/", "block"), ("org", None, "block"), ("com", "/x", "why"), ("h3.com", "", "allow"), ("h4.com", "/de/4", "allow")]

    def plain(url, rules):
        rest = re.split("[?#]", url.split("://", 1)[1])[0] if url and "://" in url else ""
        host = rest.split("/", 1)[0]
        path = rest[len(host):]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), len(h), a, h + p) for h, p, a in rules if h is not None and p is not None and a in ("allow", "block")
                and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, "allow", None))
        return host, path, best[3], best[2]

    frame = spark.createDataFrame([(i, u, "h", "p", "r", 1, 1) for i, u in pages], "page_id long, url string, host string, path string, rule string, copies int, labels int").repartition(4)
    for rules in (url_filter.FIXED_RULES, more):
        listed = spark.createDataFrame([(*r, "v", 7) for r in rules], url_filter.RULES + ", verdict string, page_id int")
        want = sorted(((i, *plain(u, rules)) for i, u in pages), key=str)
        for small in (100, 2):                        # broadcast, and salted shuffle
            assert sorted((tuple(r) for r in url_filter.judge(frame, listed, small=small).collect()), key=str) == want
    assert {(r.rule, r.verdict) for r in url_filter.judge(frame, listed.limit(0), default="block").collect()} == {(None, "block")}
    assert url_filter.judge(frame.limit(0), listed).count() == 0


def test_registered_queries(spark):
    d = "/root/testdata/sf0.001"
    for key, table, of in (("op11_conversation_repair", "conversations", "conv_id"), ("op12_periodic_runs", "documents", "doc_id"), ("op13_url_filter", "pages", "page_id")):
        got = queries.QUERIES[key](spark, d)
        assert sorted(r[0] for r in got.select(of).collect()) == sorted(r[0] for r in spark.read.parquet(f"{d}/{table}.parquet").select(of).distinct().collect())
    want = plain_conversations([tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])
    assert as_rows(queries.QUERIES["op11_conversation_repair"](spark, d)) == want
    texts = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op12_periodic_runs"](spark, d).collect()}
    assert all(got[r.doc_id] == plain_periodic(r.doc_id, r.text) for r in texts if len(r.text or "") < 4000)


def test_all_short_patterns():
    """Cost, audit and order over all sequences of three rows."""
    kinds = [(r, f) for r in "suat" for f in (0, 1, 3)]
    names = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    for rows in itertools.product(kinds, repeat=3):
        out = []
        path = conversations.Repair(lambda row, letters, out=out: out.append(letters))
        for i, (r, f) in enumerate(rows):
            path.add(i, r, f)
        assert (path.end(), "".join(out)) == cheapest([(names[r], "", ("", "blank", "", "truncated")[f]) for r, f in rows])[:2]
