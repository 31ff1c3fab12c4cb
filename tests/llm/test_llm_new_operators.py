"""Periodic runs, chat formatting and hard negatives against brute-force versions, and on odd rows."""

import gzip
import hashlib
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from goldenloom.llm import chat, common, licenses, negatives, periods, pii, quality, queries, simhash, similar, warc

DATA = "/root/testdata/sf0.001"
CLASH = ("id", "row", "n", "v", "runs", "segments", "block", "rank", "a.b", "__id")


# 11. Periodic runs


def brute_runs(w, least, times):
    found = set()
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(least, times * q) and not any(all(w[x] == w[x + r] for x in range(i, i + n - r)) for r in range(1, q)):
                found.add((i, n, q))
            i = j + 1
    return sorted(found)


def test_runs_are_those_of_brute_force():
    rng = random.Random(5)
    for case in range(1500):
        texts = []
        for _ in range(rng.randint(1, 4)):
            k, n = rng.choice([1, 2, 3, 5]), rng.randint(0, 40)
            t = [b"%d" % rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.6:
                p, a = rng.randint(1, 6), rng.randrange(n)
                t = [t[a + (i - a) % p] if i >= a and a + (i - a) % p < n else t[i] for i in range(n)]
            texts.append(t)
        times, least = rng.choice([2, 3, 4]), rng.choice([2, 6])
        for t, got in zip(texts, periods.text_runs(texts, least, times)):
            assert [tuple(map(int, x)) for x in got] == brute_runs(t, least, times), (case, t)


def test_suffix_structures():
    rng = random.Random(2)
    for n in (1, 2, 9, 60, 300):
        s = np.array([*(rng.randrange(3) for _ in range(n)), 9])
        sa, rank = periods.suffix_array(s)
        want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
        assert sa.tolist() == want and all(sa[r] == i for i, r in enumerate(rank))
        ahead = periods.Extensions(s)
        i, j = np.array([(a, b) for a in range(n) for b in range(n + 1) if a != b]).T
        same = [next(k for k in range(n + 2) if max(a, b) + k > n or s[a + k] != s[b + k]) for a, b in zip(i, j)]
        assert ahead.of(i, j).tolist() == same
        assert periods.next_smaller(rank.tolist()).tolist() == [next((j for j in range(i + 1, n + 1) if rank[j] < rank[i]), n + 1) for i in range(n + 1)]


def planted(doc_id, text):
    w, h = (text or "").encode().split(), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    return w


def test_op11_is_brute_force(spark):
    want = []
    for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect():
        w = planted(r.doc_id, r.text)
        runs = brute_runs(w, 6, 4)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((r.doc_id, len(runs), best and best[1], best and -best[0], best and best[2], best and 1000 * -best[0] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(), len(w)))
    got = sorted(map(tuple, queries.op11_periodic_runs(spark, DATA).collect()))
    assert got == sorted(want) and sum(x[1] > 0 for x in want) >= 15


def test_runs_on_odd_rows(spark):
    long = " ".join("ab"[i % 2] for i in range(200_000))
    odd = [(None, "x x x x x x"), (1, None), (2, ""), (3, " \t\n"), (4, long), (5, "a b a b a b a b"), (5, "a b a b a b a b"), (6, "é é é é é é é é")]
    df = spark.createDataFrame(odd, "doc_id long, text string").withColumns({c: F.lit(7) for c in CLASH})
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periods.periodic_runs(df).collect()), key=str)
    assert got == sorted([
        (None, 6, [(0, 6, 1)], "x"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 200_000, [(0, 200_000, 2)], "a b"),
        (5, 8, [(0, 8, 2)], "a b"), (5, 8, [(0, 8, 2)], "a b"), (6, 7, [(1, 6, 1)], "é é é"),
    ], key=str)
    assert periods.periodic_runs(df.where("false")).count() == 0


def test_texts_of_several_batches_are_read_as_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(periods, "WORDS_AT_ONCE", 50)
    rng = random.Random(3)
    texts = [[rng.choice([b"a", b"b"]) for _ in range(rng.randrange(80))] for _ in range(40)]
    together = periods.text_runs(texts)
    assert all(np.array_equal(a, periods.text_runs([t])[0]) for a, t in zip(together, texts))


# 12. Chat formatting


def turns_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(7) for c in CLASH})


def back(made):
    return {r.conv_id: r for r in made.select("conv_id", "n_turns", "valid", "bad_turn", "segments", chat.written(F.col("segments")).alias("text"), chat.trained_text(F.col("segments")).alias("loss"), chat.read_turns(chat.written(F.col("segments"))).alias("turns")).collect()}


def test_odd_texts_and_roles_come_back(spark):
    rng = random.Random(4)
    parts = ["\\", "\\\\", "#", "##", "###", "####", "</turn>", "<", "/turn>", "</turn>\n", "### Assistant: ", ": ", "\n", "~", "é😀", "$0", "", " ", "</</turn>turn>", "<\\/turn>"]
    roles = ["user", "assistant", "system", "tool", None, "", "Assistant", "~x", "a: b", "x:", "### User: ", "</turn>\n"]
    rows = [(c, t, rng.choice(roles), "".join(rng.choice(parts) for _ in range(rng.randrange(9)))) for c in range(120) for t in range(rng.randint(1, 7))]
    rows += [(-1, None, "user", "no turn"), (-1, 3, "assistant", None), (None, 0, "user", "x" * 200_000), (-2, 0, "user", "same"), (-2, 0, "user", "same")]
    got = back(chat.format_chats(turns_of(spark, rows)))
    for conv in {r[0] for r in rows}:
        r = got[conv]
        want = [(x[2] or "", x[3] or "") for x in rows if x[0] == conv]
        assert r.n_turns == len(want) and [(t.role, t.text) for t in r.turns] == want
        assert r.loss == "".join(t for role, t in want if role == "assistant")
        assert r.text == "".join(s.text for s in r.segments) and r.text.count("</turn>\n") == len(want)
        assert [s.loss for s in r.segments] == [x for role, _ in want for x in (False, role == "assistant", False)]
    assert chat.format_chats(turns_of(spark, rows).where("false")).count() == 0


def test_machine_names_the_first_bad_turn(spark):
    cases = {"ua": None, "sua": None, "u": None, "uau": None, "s": 1, "a": 0, "uu": 1, "usa": 1, "ssu": 1, "uaa": 2, "ut": 1, "uaxu": 2}
    names = {"u": "user", "a": "assistant", "s": "system", "t": "tool", "x": None}
    rows = [(k, i, names[r], "t") for k, roles in enumerate(cases) for i, r in enumerate(roles)]
    got = back(chat.format_chats(turns_of(spark, rows)))
    assert {roles: got[k].bad_turn for k, roles in enumerate(cases)} == cases
    assert all(got[k].valid == (bad is None) for k, bad in enumerate(cases.values()))


def test_other_templates(spark):
    other = chat.ChatTemplate(names={"user": "U", "bot": "B"}, opening="[[", after_name="]>", closing="@;;", trained=("bot",), transitions={"": ("user",), "user": ("bot",), "bot": ("user",)}, final=("bot",))
    rows = [(1, 0, "user", "[[B]]@;;\\"), (1, 1, "bot", "@@;;;]>"), (2, 0, "user", "?")]
    made = chat.format_chats(turns_of(spark, rows), other)
    got = {r.conv_id: r for r in made.select("conv_id", "bad_turn", chat.read_turns(chat.written(F.col("segments")), other).alias("turns"), chat.trained_text(F.col("segments")).alias("loss")).collect()}
    assert [tuple(t) for t in got[1].turns] == [(x[2], x[3]) for x in rows[:2]] and got[1].loss == "@@;;;]>" and got[1].bad_turn is None and got[2].bad_turn == 1
    for wrong in ({"closing": "aXa"}, {"closing": "x"}, {"after_name": "\\:"}, {"names": {"a": "~A"}}, {"names": {"a": "X", "b": "X"}}):
        with pytest.raises(ValueError):
            chat.ChatTemplate(**wrong)


# 13. Hard negatives


def brute_negatives(rows, anchors, n_pos=5, n_neg=10):
    """rows: (id, label, vector of floats)."""
    width = max((len(v) for _, _, v in rows), default=0)
    whole = [[math.floor(256 * x) for x in v] + [0] * (width - len(v)) for _, _, v in rows]
    out = []
    for a, (aid, alabel, _) in enumerate(rows):
        if not anchors(aid):
            continue
        score = [sum(x * y for x, y in zip(whole[a], w)) for w in whole]
        order = sorted((i for i in range(len(rows)) if i != a), key=lambda i: (-score[i], rows[i][0]))
        for p in [i for i in order if rows[i][1] == alabel][:n_pos]:
            band = [i for i in order if rows[i][1] != alabel and 30 * score[p] <= 100 * score[i] <= 90 * score[p]][:n_neg]
            out += [(aid, rows[p][0], k + 1, rows[i][0], score[p], score[i]) for k, i in enumerate(band)]
    return sorted(out)


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({c: F.lit(7) for c in CLASH})


def clustered(rng, n, dims):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    return [(i, rng.randrange(3), [x + rng.gauss(0, 0.2) for x in centres[i % 6]]) for i in range(n)]


@pytest.mark.parametrize("blocks", [(4, 16), (256, 8192)])
def test_negatives_are_those_of_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "ANCHORS", blocks[0])
    monkeypatch.setattr(negatives, "VECTORS", blocks[1])
    rng = random.Random(6)
    rows = clustered(rng, 300, 5)
    rows += [(1000 + i, i % 3, [1.0, 0.0, 0.0, 0.0, 0.0]) for i in range(60)]  # equal vectors: ties by id
    rows += [(2000, 1, []), (2010, 2, [0.5]), (2020, 0, [-3.0, 2.0]), (2030, 9, [0.1] * 5), (0, 0, rows[0][2]), (40, 2, rows[40][2])]  # short, lone label, repeated ids
    odd = [(None, 1, [1.0]), (7, None, [1.0]), (8, 1, None), (9, 1, [1.0, None]), (10, 1, [float("nan")]), (20, 1, [float("inf"), 0.0])]
    got = negatives.hard_negatives(vectors_of(spark, [*rows, *odd]), "vec_id % 10 = 0")
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 500


def test_certified_searches_leave_blocks_unread(spark, monkeypatch):
    monkeypatch.setattr(negatives, "VECTORS", 32)
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    read = []
    written = negatives.table

    def watched(df, name):
        out = written(df, name)
        if name == "negatives-pairs":
            read.append(out.count())
        return out

    monkeypatch.setattr(negatives, "table", watched)
    rng = random.Random(8)
    centres = [[rng.gauss(0, 4) for _ in range(4)] for _ in range(20)]
    rows = [(i, i % 20 % 7, [x + rng.gauss(0, 0.02) for x in centres[i % 20]]) for i in range(2000)]
    got = negatives.hard_negatives(vectors_of(spark, rows), "vec_id % 500 = 0", n_positives=2, n_negatives=3)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, lambda i: i % 500 == 0, 2, 3)
    assert sum(read[: len(read) // 2]) < 2000 / 32 * 4 / 2, read


def test_negatives_of_nothing(spark):
    one = vectors_of(spark, [(0, 1, [1.0, 2.0])])
    for df in (one.where("false"), one, one.withColumn("embedding", F.lit(None).cast("array<double>"))):
        assert negatives.hard_negatives(df, "vec_id % 10 = 0").count() == 0
    assert negatives.hard_negatives(vectors_of(spark, [(1, 1, [1.0]), (2, 1, [2.0])]), "vec_id % 10 = 0").count() == 0
    large = [(0, 1, [1e30, -1e30]), (1, 1, [1e30, 0.0]), (2, 2, [9e4, 0.0])]
    held = 1 << 25
    assert [tuple(r) for r in negatives.hard_negatives(vectors_of(spark, large), "vec_id = 0").collect()] == [(0, 1, 1, 2, held * held, held * int(9e4 * 256))]


# 7. Large payloads


def test_archives_are_bounded_by_bytes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "SMALL", 100)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    rows = [(i, "http://x.example/", "p" * n) for i, n in enumerate([5, 90, 1000, 1001, 999, 1001, 1001, 7, 950])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_warc(pages, f"file://{tmp_path}/w")
    sizes = [f.stat().st_size for f in (tmp_path / "w").glob("part-*")]
    assert max(sizes) <= 3000 + 3 * 700 and len(sizes) >= 3
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_and_read(pages).collect()}
    assert got == {i: (len(h), "revisit" if i in (5, 6) else "response", 3 if i in (5, 6) else None) for i, _, h in rows}


def test_many_members_are_read_in_time_in_proportion():
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 2000\r\n\r\n" + bytes(range(200)) * 10 + b"\r\n\r\n"
    members = gzip.compress(record, 1)

    def seconds(n):
        began = time.process_time()
        assert sum(h is not None for _, _, h, _ in warc.records(members * n)) == n
        return time.process_time() - began

    seconds(100)
    assert seconds(16_000) < 30 * max(seconds(1_600), 0.05)


# 2. Secrets and terms


def entity_spans(t):
    digits = lambda x: regex.sub("[^0-9]", "", x)
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def secret(x):
        n = Counter(x)
        return len(regex.findall("[A-Za-z][0-9]", x)) >= 3 and -sum(c * math.log2(c / len(x)) for c in n.values()) >= 64

    kinds = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda x: True), (r"[0-9]+(?:\.[0-9]+){3}", lambda x: all(int(p) <= 255 for p in x.split("."))),
        (r"[0-9](?:[ -]?[0-9])+", lambda x: 12 <= len(digits(x)) <= 19 and luhn(digits(x))), (r"\+[0-9][ ().0-9-]+[0-9]", lambda x: 9 <= len(digits(x)) <= 15),
        (r"[A-Za-z0-9+/_=-]{20,}", secret),
    )
    return sorted((m.start(), k, m.end()) for k, (pattern, good) in enumerate(kinds) for m in regex.finditer(pattern, t) if good(m[0]))


def brute_spans(rows):
    """Every span of each text by the method, with all lines counted one by one."""
    words = lambda line: set(regex.findall(r"\p{L}{4,}", line.lower()))
    alone, together, held, total, found = Counter(), Counter(), Counter(), 0, []
    for _, text in rows:
        text, at, lines = text or "", 0, []
        entities = entity_spans(text)
        for line in text.split("\n"):
            kinds = {k for s, k, _ in entities if at <= s < at + len(line)}
            lines.append((at, line, kinds))
            alone.update(words(line))
            held.update(kinds)
            together.update((k, w) for k in kinds for w in words(line))
            at += len(line) + 1
        total += len(lines)
        found.append((entities, lines))
    risky = {(k, w) for (k, w), n in together.items() if n >= 5 and held[k] < total and math.log2(n * total / (alone[w] * held[k])) / math.log2(total / held[k]) >= 0.8 - 1e-12}
    out = []
    for entities, lines in found:
        spots = {(at + m.start(), at + m.end()) for at, line, kinds in lines for m in regex.finditer(r"\p{L}{4,}", line) for k in kinds if (k, m[0].lower()) in risky}
        free = [(s, 5, e) for s, e in spots if not any(a < e and s < z for a, _, z in entities)]
        out.append(",".join(f"{('email', 'ip', 'card', 'phone', 'secret', 'term')[k]}:{s}:{e}" for s, k, e in sorted([*entities, *free])))
    return out


def test_all_spans_are_those_of_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    key = lambda i: hashlib.sha1(b"%d" % i).hexdigest()
    rows += [(9000 + i, f"the vaultkey here = {key(i)} and MORE\nnext line {i}") for i in range(12)]
    rows += [(9100 + i, f"write to deskmail u{i}@x.example.com or {key(90 + i)}@y.example.org\u00e9") for i in range(7)]
    rows += [(9200, "a" * 40 + " " + "12345" * 6 + " a1b2c3" + "x" * 30), (9201, "pre/" + key(1) + "=="), (9202, None), (9203, "")]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_spans(rows)
    assert [got[i].spans for i, _ in rows] == want
    assert "term:4:12" in got[9000].spans and "secret:" in got[9000].spans and not got[9200].spans.count("secret") and sum("term" in w for w in want) >= 15
    assert all(r.n_spans == (r.spans.count(":") // 2) and r.n_secret == r.spans.count("secret") for r in got.values())


# Near-dedup of boilerplate


def test_boilerplate_brings_no_pairs(spark):
    """Texts of 32 common and 4 own words: none are similar, and all share their shingles but for the last."""
    common = " ".join(f"c{k}" for k in range(32))
    rows = [(i, f"{common} " + " ".join(f"w{i}x{k}" for k in range(4))) for i in range(6000)]
    rows += [(10_000 + i, f"{common} " + " ".join(f"w{i}x{k}" for k in range(3)) + " z") for i in range(0, 6000, 600)]
    began = time.time()
    left = similar.drop_similar(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in left.select("doc_id").collect()) == list(range(6000)) and time.time() - began < 120


# 10. Templates


def brute_licenses(rows, templates):
    """Labels and score of each text with every template tried at every place."""
    out = {}
    phrases = [(label, p.split()) for label, p in licenses.PHRASES]
    for i, text in rows:
        w = [x for x in regex.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if x]
        labels, best = {label for label, p in phrases for k in range(len(w)) if w[k : k + len(p)] == p}, 0.0
        for label, words, keys in templates:
            t = words.split()
            needs = [(len(words[: words.index(key)].split()), key.split()) for key in keys.split("|")]
            for start in range(-len(t), len(w)):
                if all(start + at >= 0 and w[start + at : start + at + len(key)] == key for at, key in needs):
                    labels.add(label)
                    best = max(best, sum(0 <= start + k < len(w) and w[start + k] == x for k, x in enumerate(t)) / len(t))
        out[i] = (",".join(sorted(labels)), best)
    return out


def test_labels_and_scores_are_those_of_brute_force(spark):
    rng = random.Random(11)
    rows = [(r.doc_id, r.text[:4000]) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").where("length(text) > 50").limit(60).collect()]
    for k, (label, words, keys) in enumerate(licenses.TEMPLATES):
        t = words.split()
        cut = [x if rng.random() > 0.1 else "other" for x in t]
        rows += [(5000 + 10 * k, f"Before. {words.title()}; after"), (5001 + 10 * k, " ".join(cut)), (5002 + 10 * k, f"{' '.join(t[: len(t) // 2])} cut {' '.join(t[len(t) // 2 :])}"), (5003 + 10 * k, keys.replace("|", " ... "))]
    rows += [(9000, None), (9001, ""), (9002, "\n".join(words for _, words, _ in licenses.TEMPLATES))]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_licenses(rows, licenses.TEMPLATES)
    assert {i: x[0] for i, x in got.items()} == {i: x[0] for i, x in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 1e-12 for i in want) and sum(x[1] == 1.0 for x in want.values()) >= len(licenses.TEMPLATES)


# 9. Verdicts


def jensen_shannon(a, b):
    if not sum(a) or not sum(b):
        return None
    p, q = [x / sum(a) for x in a], [x / sum(b) for x in b]
    part = lambda x, m: x * math.log2(x / m) if x else 0.0
    return math.sqrt(max(0.0, sum(part(x, (x + y) / 2) + part(y, (x + y) / 2) for x, y in zip(p, q)) / 2))


def histograms(text, lang):
    kinds = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\x0b\x0c\r", ".,;:!?\"'()-", "#*$%&|<>@/\\[]{}=+_~^`" + "".join(map(chr, [*range(9), *range(14, 32), 127])))
    n = Counter(text)
    classes = [sum(n[c] for c in kind) for kind in kinds]
    words, common = text.encode().split(), [w.encode() for w in quality.COMMON.get(lang, [])]
    found = Counter(w for w in words if w in set(common))
    bins = [len(words) - sum(found.values()), *(found[w] for w in common)]
    return [*classes, len(text) - sum(classes)], [*bins, *[0] * (31 - len(bins))], len(words)


def test_verdicts_are_those_of_brute_force(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/documents.parquet").collect()]
    rows += [(9000, "the of and " * 40, "en"), (9001, "Zw9 " * 80, "en"), (9002, "| 17 | 23 " * 60, "xx"), (9003, None, "en"), (9004, "wort " + "und " * 70, None)]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    made = {i: (lang if lang in quality.COMMON else "other", *histograms(t or "", lang if lang in quality.COMMON else "other"), len(t or "")) for i, t, lang in rows}
    sums = {}
    for lang, classes, bins, n, _ in made.values():
        if n >= 50:
            a, b = sums.setdefault(lang, ([0] * 7, [0] * 31))
            sums[lang] = [x + y for x, y in zip(a, classes)], [x + y for x, y in zip(b, bins)]
    rejected = 0
    for i, (lang, classes, bins, n, chars) in made.items():
        ref_classes, ref_bins = sums.get(lang, ([], []))
        c, w, end = jensen_shannon(classes, ref_classes), jensen_shannon(bins, ref_bins), jensen_shannon([1, *[0] * 30], ref_bins)
        assert (got[i].class_distance is None) == (c is None) and (c is None or abs(got[i].class_distance - c) < 1e-9) and (w is None or abs(got[i].word_distance - w) < 1e-9), i
        rare = end is not None and w is not None and end >= 0.1 and w > 0.8 * end and 7 * (n - bins[0]) < (1 - ref_bins[0] / sum(ref_bins)) * n
        far = chars >= 200 and (c or 0) > 0.35 or lang != "other" and n >= 60 and rare
        assert got[i].kept == (not got[i].base_failed and not far), i
        rejected += far and not got[i].base_failed
    assert rejected > 20


# Joins of hot keys


def test_hot_keys_and_others_join_as_one(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2500).alias("k"), "id")
    right = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("k % 7 <> 1")
    for share in (1, 1000, 10**9):  # none, some and all of them hot
        got = common.join_heavy(rows, right, "k", share)
        assert sorted(map(tuple, got.select("k", "id", "first").collect())) == sorted(map(tuple, rows.join(right, "k").select("k", "id", "first").collect()))
    assert common.join_heavy(rows.where("false"), right.where("false"), "k").count() == 0


def test_near_duplicates_of_a_hot_print_and_many_others(spark):
    """Beyond the share from which a print is hot, with brute force over the distinct ones."""
    texts = [f"word{i} other{i} third{i} fourth{i}" for i in range(1500)] + ["the same text everywhere"] * 900
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()}
    prints = {i: simhash.fingerprint(t) for i, t in enumerate(texts)}
    assert all(int(got[i][0], 16) == p for i, p in prints.items())
    near, distinct = {}, sorted(set(prints.values()))
    a = np.array(distinct, np.uint64)
    for p in distinct:
        near[p] = [int(x) for x in a[np.bitwise_count(a ^ np.uint64(p)) <= 2]]
    least = {}
    for i in sorted(prints):
        if prints[i] not in least:
            open_ = [prints[i]]
            while open_:
                p = open_.pop()
                if p not in least:
                    least[p] = i
                    open_ += near[p]
    assert all(got[i][1] == least[p] for i, p in prints.items())


def test_units_are_counted_in_small_runs():
    import tracemalloc

    import pyarrow as pa

    from goldenloom.llm import sentencepieces

    rng = random.Random(5)
    texts = [" ".join(f"{rng.choice(('north', 'South', 'x'))}{rng.randrange(3000)}" for _ in range(400)) for _ in range(800)] + [None, "", "  a"]
    cut, seen = sentencepieces.Cutter(frozenset(["▁n", "no", "or", "▁S", "So", "▁▁"] + [f"{a}{b}" for a in range(10) for b in range(10)])), sentencepieces.Seen()
    tracemalloc.start()
    for run in sentencepieces.chunks(pa.array(texts)):
        seen.add(cut(run))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    told = seen.told()
    whole = cut(texts)
    assert dict(zip(told.column(0).to_pylist(), told.column(1).to_pylist())) == Counter(whole.named(np.arange(len(whole.starts))))
    assert told.column(0).to_pylist() == sorted(set(told.column(0).to_pylist())) and peak < 40e6, peak


def test_units_are_cut_without_a_table_of_all_letters(spark):
    import tracemalloc

    from goldenloom.llm import sentencepieces

    texts = [f"{chr(a)}b{chr(b)} {chr(b)}" for a, b in zip(range(0x400, 0xD000, 97), range(0x1F300, 0x2F300, 97))]
    tracemalloc.start()
    cut = sentencepieces.Cutter(frozenset(["\u2581\u4e00", "ab", "b\U0001f300"]))
    units = cut(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    names = units.named(np.arange(len(units.starts)))
    assert len(set(zip(units.first.tolist(), units.second.tolist()))) == len(set(units.first.tolist())) == len(set(names))
    assert peak < 12e6, peak
    # The model's pieces pass no Python workers: they would stay beside the scans' own.
    model = sentencepieces.Pieces((("a", 0, -1.0), ("ab", 1, -1.5), ("\u2581", 2, -2.0)), tuple(range(3, 259)), 259)
    made = sentencepieces.lattice(spark.createDataFrame([("\u2581ab", 1, 3)], "unit string, n long, len int"), model)
    pieces = [p for p in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "piece#" in p and ("RDD" in p or "LocalRelation" in p)]
    assert pieces and not any("RDD" in p for p in pieces), pieces
    assert made.collect()[0]["path"] == [2, 1]


def test_units_go_to_finer_partitions(spark, tmp_path, monkeypatch):
    from goldenloom.llm import sentencepieces

    asked, table = [], sentencepieces.table

    def told(df, name):
        asked.append(spark.conf.get("spark.sql.shuffle.partitions"))
        return table(df, name)

    monkeypatch.setattr(sentencepieces, "table", told)
    model = sentencepieces.Pieces((("a", 0, -1.0), ("ab", 1, -1.5), ("\u2581", 2, -2.0)), tuple(range(3, 259)), 259)
    docs = spark.createDataFrame([(1, "ab a"), (2, None), (3, "ab" * 50)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = {r["doc_id"]: r["ids"] for r in sentencepieces.round_trip(docs, model, with_ids=True).collect()}
    assert asked == [str(4 * int(before))] and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert got == {1: [2, 1, 2, 0], 2: [], 3: [2] + [1] * 50}
    assert sentencepieces.unit_partitions(3000) == 3000


def test_intermediate_tables_leave_no_shuffle_files(spark):
    shuffles = lambda: {x for x in str(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()).split(", ") if "shuffle_" in x}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, left, wanted = spark.conf.get(key), shuffles(), spark.range(5000).groupBy("id").count()
    made = common.table(wanted, "no-shuffles")
    until = time.time() + 20
    while shuffles() - left and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - left
    assert spark.conf.get(key) == before and made.count() == wanted.count() == 5000
    # What shares a table's plan is worked out again.
    both = wanted.join(made.withColumnRenamed("count", "n"), "id")
    assert common.table(both, "first").count() == common.table(both, "second").count() == both.count() == 5000
    assert all(".zstd." in f for f in made.inputFiles())


def test_paths_of_gaps_are_written_before_texts_are_shuffled(spark):
    from goldenloom.llm import sentencepieces

    model = sentencepieces.Pieces((("a", 0, -1.0), ("ab", 1, -1.5), ("\u2581", 2, -2.0)), tuple(range(3, 259)), 259)
    given = [(1, "ab a"), (2, None), (3, "ab" * 50), (4, "ab a"), (5, "b\u00e9 ab"), (None, "a")]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    moved, results = [], []
    for frequent in (0, 1, 100):  # all, some and none of the units are rare
        with common.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            made = sentencepieces.round_trip(docs, model, frequent=frequent, with_ids=True)
            moved.append(made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
            results.append(sorted(map(str, made.collect())))
    assert moved == [2, 2, 0] and results[0] == results[1] == results[2] and all("restored=True" in r for r in results[0])
