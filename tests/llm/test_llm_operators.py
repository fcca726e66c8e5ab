"""Each training-data operator against brute force or an exact round trip, on small and awkward tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import chat, decontam, licences, minhash, mixing, quality, substrings, tokens, toxicity, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, n string"
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(t):
    return SPACE_WORD.findall(t or "")


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    vocabulary = [a + b for a in "the on re st ing ver qu lo".split() for b in "an er ou ti ch a e ble".split()]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n)) + "."
    base = text(120)
    near = [base.split(" ") for _ in range(12)]
    for w in near:
        for _ in range(2):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
    passage = text(60)
    texts = [None, "", "  \n\t ", "one", "one", "One two", base, base, base.upper(), *(" ".join(w) for w in near), text(40) + passage + text(20),
             text(3) + passage, text(5000), "a" * 700, "é ñ ß" * 100, "x\x00y <|endoftext|> a  b   c \n\n d", "\x85 \u3000 z", text(70).replace(" ", "### ")]
    out = [(i, t, ("en", "fr", None, "xx")[i % 4], ("a", "b", None)[i % 3] if i % 7 else "a", 0, "x", "y", "z") for i, t in enumerate(texts)]
    return out + [out[6], out[6], out[10], (None, base, "en", "a", 0, "x", "y", "z"), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def brute_components(rows, percent=75):
    sets = {}
    for d, t, *_ in rows:
        if d is not None:
            w = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
            sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def test_near_duplicates_equal_all_pairs(docs, rows, none):
    want = brute_components(rows)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(d for d, (_, c) in want.items() if c == d)
    assert minhash.near_duplicates(none).count() == 0


def test_a_repeated_id_with_another_text_is_a_document_of_its_own(spark):
    rnd = random.Random(1)
    text = lambda: [f"w{rnd.randrange(10**6)}" for _ in range(80)]
    a, b, z = text(), text(), text()
    change = lambda t: " ".join([*t[:40], "other", *t[41:]])
    rows = [(5, " ".join(a), "x", 1), (5, " ".join(b), "y", 2), (6, change(a), "x", 3), (7, change(b), "y", 4), (5, " ".join(b), "y", 2), (8, " ".join(z), "x", 5), (5, "", "x", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, nth int").withColumn("component", F.lit(1)).withColumn("text_hash", F.lit(2))
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == [(5, 0, 5, True), (5, 76, 5, True), (5, 76, 5, True), (5, 76, 5, True), (6, 76, 5, False), (7, 76, 5, False), (8, 76, 8, True)]
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id, r["nth"]) for r in kept.collect()) == [(5, 1), (5, 2), (5, 6), (8, 5)]


def test_distances_follow_from_the_similarity():
    assert minhash.near_distance(75) == 42 and minhash.near_distance(90) < 42 and minhash.near_distance(100) == 0
    with pytest.raises(ValueError):
        minhash.drop_near_duplicates(None, percent=70)


def test_hot_key_is_compared_in_blocks(docs, rows, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 2)
    want = brute_components(rows)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert all(got[d] == c for d, (_, c) in want.items())


def test_quality_counts(docs, rows, none):
    got = quality.quality_report(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for d, t, *_ in rows:
        if d is None:
            continue
        w, t = words_of(t), t or ""
        windows = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        marked = {k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if words_of(x)]
        r = by_id[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(marked))
        assert r.base_failed == (len(w) < 50 or 100 * len(marked) > 50 * len(w)) and (not r.kept or not r.base_failed)
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert quality.quality_report(none).count() == 0


def least_distance(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_decontamination_equals_edit_distance(spark, none):
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choice("abc de") for _ in range(n))
    items = [(k, "item " + text(60 + 30 * k)) for k in range(4)] + [(8, None), (9, ""), (10, " Short\tone "), (11, "What is 17 times 23?"), (12, "7"), (13, "é")]
    tests, docs = spark.createDataFrame(items, "item_id long, text string"), []
    for n in range(60):
        t = list(items[n % 4][1])
        for _ in range(n % 9):
            p = rnd.randrange(len(t))
            t[p:p + 1] = rnd.choice(["", "x", t[p] + "y"])
        docs.append((n, text(40) + "".join(t).upper().replace(" ", "\n \t") + text(30)))
    docs += [(100, None), (101, ""), (102, text(500)), (None, items[0][1]), (103, "a SHORT  one"), (104, "short ones, ashort one"), (105, "short one"),
             (106, "so: what is 17 times 23?? 17"), (107, "what is 17 times 2 3? x7 7x é7"), (108, "7"), (109, "caf\u00e9 \u00e9t\u00e9"), (110, "-é-7")]
    frame = spark.createDataFrame([(*d, "z") for d in docs], "doc_id long, text string, item_id string")
    want = set()
    for d, t in docs:
        for k, x in items:
            x, y = decontam.normalise(x), decontam.normalise(t)
            if len(x) >= decontam.LEAST_ITEM_BYTES and y and (e := least_distance(x, y)) <= decontam.budget(len(x)):
                want.add((d, k, e))
    want |= {(103, 10, 0), (105, 10, 0), (106, 11, 0), (108, 12, 0), (110, 12, 0), (110, 13, 0)}  # the short items, by hand
    assert {(r.doc_id, r.item_id, r.distance) for r in decontam.leaks(frame, tests).collect()} == want
    left = decontam.decontaminate(frame, tests)
    assert left.columns == frame.columns and {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {d for d, _, _ in want}
    assert decontam.leaks(none, tests).count() == 0 and decontam.leaks(frame, tests.limit(0)).count() == 0


def test_decontamination_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontam, "ITEM_BLOCK_BYTES", 50)
    items = spark.createDataFrame([(k, f"benchmark question number {k} with some words") for k in range(3)], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"so: benchmark question number {k} with some words, yes") for k in range(3)], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).where("distance = 0").collect()} == {(k, k) for k in range(3)}


def test_licences(spark, none):
    lines = {f: ts[0] for f, ts in licences.TEMPLATES.items()}
    filler = "then the answer came over the hill and no one saw it\nwe may license nothing here to anyone"
    docs = [(i, f"{filler}\n{t}\nmore text") for i, t in enumerate(lines.values())] + [
        (50, filler), (51, None), (52, ""), (53, "\n\n"), (54, lines["mit"].lower()), (None, lines["apache"]), (0, f"{filler}\n{list(lines.values())[0]}\nmore text")]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, family string")
    got = {(r.doc_id, *r.families) for r in licences.document_licences(frame).collect()}
    assert got == {(i, f) for i, f in enumerate(lines)} | {(54, "mit"), (None, "apache")}
    assert licences.document_licences(none).count() == 0


def test_licence_lines_without_the_word_licence(spark):
    """Lines of wrapped headers are judged whatever words they hold; what the prefilter drops could not be confirmed."""
    wrapped = ["# Unless required by applicable law or agreed to in writing, software",
               "   without modification, are permitted provided that the following conditions are met:"]
    filler = "then the answer came over the hill and no one saw it"
    frame = spark.createDataFrame([(i, f"{filler}\n{t}\nmore text") for i, t in enumerate(wrapped)] + [(9, filler)], "doc_id long, text string")
    assert {(r.doc_id, r.position, r.family) for r in licences.scan(frame).collect()} == {(0, 1, "apache"), (1, 1, "bsd")}
    grams = [g for ts in licences.TEMPLATES.values() for t in ts for g in licences._template_trigrams(t)]
    lines = [sep.join(w.upper() for w in g.split(" ")) for g in grams for sep in (" ", " -- ", ", ", "\u00a0", ". ")] + ["(" + g + ")" for g in grams]
    lines += ["a copyof", "xa copy of", "a copy off", "", None, *(t for ts in licences.TEMPLATES.values() for t in ts)]
    got = spark.createDataFrame([(x,) for x in lines], "t string").select(
        licences.may_match(F.col("t")).alias("may"), (licences.overlap(None, licences.paragraph_words(F.col("t"))) > 0).alias("can"))
    assert got.where("can").count() >= len(grams) and got.where("can and not may").count() == 0
    assert [r.may for r in got.collect()][6 * len(grams):6 * len(grams) + 4] == [False] * 4


PAGES = [f"https://{h}.example.{tld}/{lang}/{n}{end}" for n, h in enumerate(["a", "m.b", "www", "c"] * 6) for tld in ("com", "net", "org")
         for lang, end in (("en", "?x=1&y"), ("fr", "#top"), ("es", ""))] + [
    None, "", "no scheme", "http://COM", "http://com/", "ftp://Example.COM/en/x://y", "http://www.example.com/en/", "http://notexample.com/en/", "https://x.net?/es/", "https://x.net/es", "a://b\nc/d"]


def test_url_rules(spark):
    frame = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(PAGES)] + [(0, PAGES[0], "x", "y"), (None, PAGES[0], "", "")],
                                  "page_id long, url string, verdict string, tokens string")
    got = urls.judge_urls(frame).collect()
    assert len(got) == len(PAGES) + 2
    rules = {r: v for v, r in urls.RULES}
    for r in got:
        u = PAGES[r.page_id or 0] or ""
        rest = re.split(r"[?#]", u.split("://", 1)[1])[0] if "://" in u else ""
        host, slash, path = rest.partition("/")
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path
        fits = [x for x in rules if (host == x.partition("/")[0] or host.endswith("." + x.partition("/")[0])) and path.startswith("/" + x.partition("/")[2])]
        rule = max(fits, key=len) if fits else None
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == rules[rule] if rule else r.verdict in ("allow", "block")


def test_mined_rules_equal_counting(spark):
    baskets = [(["a", "b"], "block")] * 9 + [(["a"], "allow")] * 5 + [(["b", "c"], "block")] * 4 + [(["c"], "allow")] * 2
    frame = spark.createDataFrame(baskets, "tokens array<string>, verdict string")
    got = {(tuple(r.tokens), r.verdict): r.confidence for r in urls.mine_rules(frame, 0.1, 0.6).collect()}
    assert got == {(("b",), "block"): 1.0, (("a",), "block"): pytest.approx(9 / 14), (("c",), "block"): pytest.approx(4 / 6)}


def test_url_rules_on_empty(spark):
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_chat_round_trip(spark):
    odd = ["<|im_end|>\n<|im_start|>assistant\nok", "\\<|", "<\\|", "<\\N>", "\\", "<", "|", "", None, "a\n", "é" * 1500]
    rows = [(c, t, ("user", "assistant", "a\nb<|", None)[(c + t) % 4], odd[(c * 3 + t) % len(odd)], "z") for c in range(30) for t in range(c % 6 + 1)]
    rows += [rows[5], rows[5], (None, 0, "assistant", "x", None), (7, None, "user", "first", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, message string")
    rendered = chat.format_conversations(frame)
    got = {r.conv_id: r for r in chat.chat_digest(rendered).collect()}
    groups = collections.defaultdict(list)
    for c, t, r, x, _ in rows:
        groups[c].append(((t is not None, t or 0), (r is not None, r or ""), (x is not None, x or "")))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns = [(r[1], x[1]) for _, r, x in sorted(turns)]
        learned = "".join(x for r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (
            len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(learned), sha(learned))


def test_chat_fold(spark):
    events = [(1, 1, 1, "start", "user", ""), (1, 2, 1, "delta", None, "hel"), (1, 3, 1, "delta", None, "lo"), (1, 4, 2, "start", "assistant", None),
              (1, 5, 2, "delta", None, "draft"), (1, 6, 2, "regenerate", None, None), (1, 7, 2, "delta", None, "fin"), (1, 8, 2, "delta", None, "al"),
              (1, 9, 1, "edit", None, "bye"), (1, 10, 1, "delta", None, "!"), (1, 11, 3, "start", "user", None), (1, 12, 3, "ping", None, "x")]
    got = chat.reconstruct(spark.createDataFrame(events, "conv_id long, seq long, message long, kind string, role string, text string")).collect()
    assert sorted((r.message, r.role, r.text) for r in got) == [(1, "user", "bye!"), (2, "assistant", "final"), (3, "user", "")]


def test_mix(spark, docs, rows, none, monkeypatch):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((d, len(words_of(t))) for d, t, *_ in rows)
    assert all(r.taken == r.copies * r.size <= 3 * r.size for r in got)
    assert mixing.mix(none).count() == 0
    rnd = random.Random(1)
    many = spark.createDataFrame([(i, "w " * rnd.randrange(1, 60), ("a", "b", "c", None)[min(3, i % 9)]) for i in range(3000)], "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 50)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    a, b = mixing.mix(many).collect(), mixing.mix(many.repartition(7)).collect()
    assert {(r.doc_id, r.taken) for r in a} == {(r.doc_id, r.taken) for r in b}
    taken, target = collections.Counter(), {}
    for r in a:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    assert sum(target.values()) == pytest.approx(sum(r.size for r in a))
    mixed = mixing.apply_mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)


def test_mix_settles_giant_documents_first(spark):
    """A source whose largest documents are a large part of it meets its target by its small ones."""
    rnd = random.Random(3)
    rows = [(1, 4000, "a"), (2, 3000, "a"), *((10 + i, rnd.randrange(20, 60), "a") for i in range(80)),  # 7000 of about 10000 words
            (200, 9000, "b"), *((300 + i, 10 + i % 7, "b") for i in range(200)),
            *((1000 + i, 50, "c") for i in range(900)), (5000, 77, "d"), (5001, 0, "d"), (5002, 0, "e"), (5, 33, None), (5, 33, None)]
    frame = spark.createDataFrame([(d, "w " * n, s) for d, n, s in rows], "doc_id long, text string, source string")
    got = mixing.mix(frame).collect()
    assert sorted((r.doc_id, r.size) for r in got) == sorted((d, n) for d, n, _ in rows)
    taken, target = collections.Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
    for s in "abc":
        assert abs(taken[s] - target[s]) <= max(0.01 * target[s], 60), (s, taken[s], target[s])
    assert sorted((r.doc_id, r.size, r.taken) for r in mixing.mix(frame.repartition(5)).collect()) == sorted((r.doc_id, r.size, r.taken) for r in got)


def test_targets_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 5)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # weights 5, 2, 1, 5: a and null stop at 30 and 15, b at 300, c has the rest
    assert got == {"a": 30.0, None: 15.0, "b": 300.0, "c": 770.0}


def test_toxicity_held_out(spark, none):
    rnd = random.Random(3)
    vocabulary = [a + b for a in "the on re st ing ver qu lo".split() for b in "an er ou ti ch a e ble".split()]
    bad = ["zorgling", "plimfuck", "grubwort"]
    docs, labels = [], []
    for i in range(400):
        w, toxic = [rnd.choice(vocabulary) for _ in range(rnd.randrange(20, 120))], i % 5 == 0
        for _ in range(3 if toxic else 0):
            w[rnd.randrange(len(w))] = rnd.choice(bad)
        docs.append((i, " ".join(w), "x"))
        labels.append((i, int(toxic)))
    docs += [(1000, None, ""), (1001, "", ""), (None, "zorgling", ""), docs[0]]
    frame, marks = spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(frame, marks).collect()}
    test = [(got[i].predicted, y) for i, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in labels)
    assert sum(p == y for p, y in test) >= 0.95 * len(test)
    assert got[1000].score == got[1001].score < 0.3 and all(0 <= r.score <= 1 for r in got.values())
    assert toxicity.toxicity(none, marks).count() == 0
    assert toxicity.toxicity(frame, marks.limit(0)).where("predicted = 1").count() == 0


def brute_repeats(rows, length=200):
    seen = collections.Counter()
    for _, t, *_ in rows:
        b = (t or "").encode()
        seen.update(b[k:k + length] for k in range(len(b) - length + 1))
    out = []
    for d, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeats_equal_window_counts(spark, docs, rows, none):
    assert sorted((tuple(r) for r in substrings.repeats_digest(docs).collect()), key=str) == brute_repeats(rows)
    rnd = random.Random(8)
    pool = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(150, 420))) for _ in range(6)]
    tricky = [(i, "".join(rnd.choice(pool)[rnd.randrange(40):] + rnd.choice(["", "x", "yy"]) for _ in range(rnd.randrange(1, 5)))) for i in range(60)]
    tricky += [(100, "ab" * 300), (101, "a" * 199), (102, "b" * 200), (103, "b" * 201)]
    frame = spark.createDataFrame(tricky, "doc_id long, text string")
    assert sorted((tuple(r) for r in substrings.repeats_digest(frame).collect()), key=str) == brute_repeats(tricky)
    assert substrings.repeats_digest(none).count() == 0


def test_repeats_of_a_large_minimizer(spark, monkeypatch):
    """A passage shared by documents that all differ around it is not indexed in one task, and the result is the same."""
    rnd = random.Random(9)
    some = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = some(320)
    rows = [(i, some(rnd.randrange(150, 300)) + passage[rnd.randrange(30):] + some(rnd.randrange(150, 300))) for i in range(40)]
    rows += [(100, "ab" * 300), (101, "b" * 203), (102, rows[0][1]), (103, None), (104, some(700))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    indexed, index = [], substrings._index
    monkeypatch.setattr(substrings, "BATCH_ROWS", 4)
    monkeypatch.setattr(substrings, "_index", lambda r: indexed.append(r.groupBy("anchor").count().selectExpr("max(count)").first()[0]) or index(r))
    got = sorted((tuple(r) for r in substrings.repeats_digest(frame).collect()), key=str)
    assert got == brute_repeats(rows) and sum(r[2] for r in got) > 40 * 280
    assert max(n or 0 for n in indexed) <= 4


def test_repeats_of_an_id_with_another_text(spark):
    rnd = random.Random(12)
    some = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    x, z = some(600), some(900)
    rows = [(5, x), (5, z), (9, x), (None, z[:300]), (None, some(250)), (7, some(400)), (7, some(400))]
    got = sorted((tuple(r) for r in substrings.repeats_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_repeats(rows) and sorted(r[2] for r in got if r[0] == 5) == [300, 600]


def test_clashing_columns(spark):
    """Stages that keep whole rows hand on columns of any name."""
    names = "row __t __w __m __q __lang __jc __jw copies copy nth size __id __size __source __nth __words __n __copy r p key part".split()
    rnd = random.Random(6)
    rows = [(i % 37, " ".join(rnd.choice(quality.COMMON_WORDS["en"]) + str(rnd.randrange(90)) for _ in range(rnd.randrange(60, 160))), "en", "ab"[i % 2],
             *(f"{n}{i}" for n in names)) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names))
    given = {tuple(r) for r in frame.collect()}
    kept = quality.quality_filter(frame)
    assert kept.columns == frame.columns and {tuple(r) for r in kept.collect()} <= given
    mixed = mixing.apply_mix(frame)
    got = collections.Counter(tuple(r) for r in mixed.collect())
    assert mixed.columns == frame.columns and set(got) <= given and max(got.values()) <= 3
    # as many rows of each id as the decisions say
    want = collections.Counter()
    for r in mixing.mix(frame).collect():
        want[r.doc_id] += r.copies
    assert +want == +collections.Counter(k[0] for k in got.elements())
    left = minhash.drop_near_duplicates(frame)
    assert left.columns == frame.columns and {tuple(r) for r in left.collect()} <= given


def test_grammar_runs_to_its_end():
    ids = np.tile(np.arange(1, 6, dtype=np.uint32), 40_000)
    symbols, firsts, rules = tokens.repair(ids, np.array([len(ids)]), 1000)
    pairs = collections.Counter(zip(symbols.tolist(), symbols.tolist()[1:]))
    assert max(pairs.values()) < tokens.LEAST_PAIRS and len(symbols) < 200
    shard = tokens.Shard(tokens.pack([ids], 1000))
    assert np.array_equal(shard.document(0), ids) and np.array_equal(shard.slice(0, 70_001, 70_009), ids[70_001:70_009])


def test_token_shards(spark, docs, rows, none, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer
    monkeypatch.setattr(tokens, "SHARD_TOKENS", 1500)
    monkeypatch.setattr(tokens, "LEAST_PAIRS", 3)
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = collections.defaultdict(list)
    for d, t, *_ in rows:
        ids[d].append(plain.encode(t or "", add_special_tokens=False).ids + [tokens.END_ID])
    shards = tokens.write_tokens(docs)
    got = sorted(tokens.token_digest(shards).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:
        crc = {zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids[r.doc_id] if len(x) == r.n_tokens}
        assert r.start == at and r.ids_crc32 in crc
        at += r.n_tokens
    assert at == sum(len(x) for xs in ids.values() for x in xs)
    for s in shards.collect():
        shard = tokens.Shard(bytes(s.payload))
        for k, d in enumerate(s.doc_ids):
            assert shard.document(k).tolist() in ids[d] and shard.slice(k, 1, 5).tolist() in [x[1:5] for x in ids[d]]
    assert tokens.token_digest(tokens.write_tokens(none)).count() == 0


def test_encoder_equals_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    plain, own, rnd = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), tokens.Encoder(), random.Random(4)
    for _ in range(1500):
        t = "".join(rnd.choice("ab'st 1!\n\t é  \x1c\x85\r  ñ中\u3000\u0301") for _ in range(rnd.randrange(14)))
        assert own.encode([t])[0].tolist() == plain.encode(t, add_special_tokens=False).ids + [tokens.END_ID]


def test_pipeline_stages(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    all_rows = {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns, name
        path = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{k}"
        after.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    left = docs.collect()
    assert left and all(all_rows[r.doc_id] == r.text for r in left)
    components = brute_components([(r.doc_id, r.text) for r in {r.doc_id: r for r in left}.values()])
    assert all(c == d for d, (_, c) in components.items())
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == len(left)


def test_encoder_cuts_and_blocks(monkeypatch):
    """Mixed white space, characters of two to four bytes, blocks of a few bytes and a cache that turns over."""
    import public_tokenizers
    from tokenizers import Tokenizer
    monkeypatch.setattr(tokens, "_BLOCK_BYTES", 64)
    monkeypatch.setattr(tokens, "_CACHE_WORDS", 50)
    plain, own, rnd = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), tokens.Encoder(), random.Random(9)
    parts = ["a", "bc", "é", "ж", "中", "😀", " ", " ", "\n", "\t", "\r", " ", "　", " ", "\x85", "\x1c", ".", "'s", "12", "<|endoftext|>"]
    texts = [None, "", *("".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 14))) for _ in range(3000))]
    got = own.encode(texts)
    assert len(got) == len(texts)
    assert all(g.tolist() == plain.encode(t or "", add_special_tokens=False).ids + [tokens.END_ID] for g, t in zip(got, texts))


def test_wide_symbols_round_trip():
    rnd = np.random.default_rng(6)
    ids = [np.concatenate([rnd.integers(0, 90_000, 40), np.tile(rnd.integers(60_000, 90_000, 5), 60), [tokens.END_ID]]).astype("<u4") for _ in range(30)]
    for base in (90_000, tokens._NARROW, 1 << 20):
        cut = [np.minimum(x, base - 1) for x in ids]
        shard = tokens.Shard(tokens.pack(cut, base))
        assert shard.symbols.itemsize == 4 and len(shard.symbols) < sum(map(len, cut))
        assert all(np.array_equal(shard.document(k), x) for k, x in enumerate(cut))
        assert np.array_equal(shard.slice(3, 35, 170), cut[3][35:170])


def test_joined_words_equal_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    plain, own, rnd = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), tokens.Encoder(), random.Random(12)
    letters = ["a", "b", "the", "'s", "'", "1", "23", "!", "<|endoftext|>", "<|", "\u00e4", "\u00d7", "\u0436", "\u4e2d", "\u00a0", "\u0120", "\x85", "\x1c", "\u2003", "\x7f"]
    texts = ["".join(rnd.choice([" "] * 6 + ["  ", "\n", "\t", " \n"]) + "".join(rnd.choices(letters, k=rnd.randrange(1, 5))) for _ in range(40)) for _ in range(300)]
    got = own.encode(texts)
    assert all(g.tolist() == plain.encode(t, add_special_tokens=False).ids + [tokens.END_ID] for g, t in zip(got, texts))


def test_signs_and_words_are_learnt_apart(monkeypatch):
    """A word is one piece whatever signs, digits or line feeds stand beside it, so the tokenizer runs for it once."""
    import public_tokenizers
    from tokenizers import Tokenizer
    plain, own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), tokens.Encoder()
    learnt, learn = [], own._learn
    monkeypatch.setattr(own, "_learn", lambda pieces: learnt.extend(pieces) or learn(pieces))
    names, signs = [f"{a}{b}" for a in ("ant", "onth", "tion") for b in ("ble", "er", "ish", "eng")], [".", ",", ")", "!", "7", ";", ":", "?"]
    texts = [f" {w}{x}\n{w}{x}\n\n {w}{x}" for w in names[:9] for x in signs] + [f"{x}\n{w}" for w in names for x in signs]
    got = own.encode(texts)
    assert all(g.tolist() == plain.encode(t, add_special_tokens=False).ids + [tokens.END_ID] for g, t in zip(got, texts))
    assert len(learnt) == len(set(learnt)) <= 2 * len(names) + len(signs) + 4


def test_cuts_between_kinds_equal_tokenizer():
    """Every pair and many runs of kinds, beside added tokens, characters of several bytes and ends of texts."""
    import public_tokenizers
    from tokenizers import Tokenizer
    plain, own, rnd = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), tokens.Encoder(), random.Random(21)
    parts = ["a", "the", "T", "'", "'s", "'ll", "1", "23", "!", ".", "(", "-", "_", "<|endoftext|>", "endoftext", "<", "|", ">", "\u00e4", "\u00d7", "\u0436", "\u4e2d",
             "\u00a0", "\u2003", "\u0120", "\x85", "\x1c", "\x0b", "\x7f", "\0", "\u0301", "\u00b2", "\u0663", "\u2019", " ", " ", " ", "\n", "\n", "\t", "\r"]
    texts = [a + b + c for a in parts for b in parts for c in ("", "a", " ", "\n")] + ["".join(rnd.choices(parts, k=rnd.randrange(12))) for _ in range(6000)]
    got = own.encode(texts)
    assert all(g.tolist() == plain.encode(t, add_special_tokens=False).ids + [tokens.END_ID] for g, t in zip(got, texts))


@pytest.mark.parametrize("added", [["the"], ["12"], ["a.b"], ["-x1-"], ["~", "-x"]])
def test_added_tokens_are_found_whole(tmp_path, added):
    import public_tokenizers
    from tokenizers import AddedToken, Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.add_special_tokens([AddedToken(t, normalized=False) for t in added])
    plain.save(str(tmp_path / "tokenizer.json"))
    own, rnd = tokens.Encoder(str(tmp_path / "tokenizer.json")), random.Random(3)
    texts = ["".join(rnd.choices(["the", "a.b", "a", ".", "b", "12", "-x1-", "-", "x1", "~", " ", "\n", "m"], k=9)) for _ in range(800)]
    assert all(g.tolist() == plain.encode(t, add_special_tokens=False).ids + [tokens.END_ID] for g, t in zip(own.encode(texts), texts))


def test_grammar_equals_plain_loop():
    """Symbols and rules against a loop over lists, with pairs that overlap and documents that end in them."""
    rnd = np.random.default_rng(8)
    for base, symbols in ((1000, 4), (1000, 2), (70_000, 3)):
        docs = [rnd.integers(0, symbols, rnd.integers(1, 40)).tolist() for _ in range(30)]
        want, rules = [list(d) for d in docs], []
        while True:
            count = collections.Counter(p for d in want for p in zip(d, d[1:]))
            frequent = [p for p, n in count.most_common() if n >= 9]
            if not frequent:
                break
            used = {}
            for k, d in enumerate(want):
                out = []
                while d:
                    pair = tuple(d[:2])
                    # of neighbours that can both be replaced, the left one is
                    hit = pair in frequent
                    if hit:
                        used.setdefault(pair, None)
                    out.append(pair if hit else d[0])
                    d = d[2 if hit else 1:]
                want[k] = out
            number = {p: base + len(rules) + i for i, p in enumerate(p for p in frequent if p in used)}
            rules += list(number)
            want = [[number.get(x, x) if isinstance(x, tuple) else x for x in d] for d in want]
        seq, firsts, got = tokens.repair(np.concatenate(docs).astype("<u4"), np.array([len(d) for d in docs]), base, 9)
        assert [seq[a:b].tolist() for a, b in zip(firsts, firsts[1:])] == want
        assert list(map(tuple, got.tolist())) == rules


def test_offsets_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(tokens, "TASK_BYTES", 40)
    monkeypatch.setattr(tokens, "PART_GROUP", 3)
    docs = spark.createDataFrame([(i, "word " * (i % 7)) for i in range(60)], "doc_id long, text string")
    got = tokens.token_digest(tokens.write_tokens(docs)).orderBy("start").collect()
    assert [r.doc_id for r in got] == list(range(60))
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()


def test_mined_verdicts_equal_counting(spark):
    """Rules, index and verdicts against counting every combination, with tokens that always go together."""
    import itertools
    rnd = random.Random(21)
    def basket():
        t = [x for x in "abcde" if rnd.random() < 0.5]
        return t + (["a1", "a2"] if "a" in t else []) + (["d1"] if "d" in t else [])
    label = lambda t: "block" if ("a" in t and "b" in t) or rnd.random() < 0.2 else "allow"
    baskets = [(t, label(t)) for t in (basket() for _ in range(120))]
    support, confidence = 0.05, 0.7
    single = {x for t, _ in baskets for x in t}
    found = {}
    for k in (1, 2, 3):
        for items in itertools.combinations(sorted(single), k):
            hold = [v for t, v in baskets if set(items) <= set(t)]
            for v in ("allow", "block"):
                n = hold.count(v)
                if n and n / len(baskets) >= support and n / len(hold) >= confidence:
                    found[items, v] = (n / len(hold), n / len(baskets))
    kept = {(i, v): c for (i, v), c in found.items()
            if not any(v == w and set(j) < set(i) and d[0] >= c[0] for (j, w), d in found.items())}
    pages = [[x for x in ("a", "a1", "a2", "b", "c", "d", "d1", "e", "z") if rnd.random() < 0.4] for _ in range(150)]
    rules = urls.mine_rules(spark.createDataFrame(baskets, "tokens array<string>, verdict string"), support, confidence)
    got = {r.row_key: r.mined for r in urls.match_rules(spark.createDataFrame(list(enumerate(pages)), "row_key long, tokens array<string>"), rules).collect()}
    for k, page in enumerate(pages):
        fits = [(c, v) for (i, v), c in kept.items() if set(i) <= set(page)]
        assert (k in got) == bool(fits)
        if fits:
            assert got[k] in {v for c, v in fits if c == max(fits)[0]}


def test_many_tokens_that_go_together(spark):
    fields = "&".join(f"f{i}=1" for i in range(30))
    frame = spark.createDataFrame([(i, f"https://a.{'com' if i % 2 else 'net'}/{'x' if i % 2 else 'es'}/{i}?{fields}") for i in range(500)]
                                  + [(900, f"https://b.org/es/1?{fields}"), (901, "https://b.org/es/1?f7")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(frame).collect()}
    assert got[0] == ("net/es/", "block") and got[1] == ("com/", "allow") and got[900] == got[901] == (None, "block")


def test_licence_confirmation_equals_sets(spark):
    rnd = random.Random(8)
    texts = [t for ts in licences.TEMPLATES.values() for t in ts]
    lines = ["you can redistribute it", "subject to the terms of the", "", "in source and binary forms", "Copyright 2021 A. All rights reserved.", None, *texts]
    for _ in range(200):
        ws = rnd.choice(texts).split(" ")
        i = rnd.randrange(len(ws))
        lines.append(" ".join(["some", "words"] * rnd.randrange(4) + ws[i:i + rnd.randrange(1, 14)] + ["more", "of", "them"] * rnd.randrange(3)))
    got = spark.createDataFrame([(x,) for x in lines], "t string").select(
        "t", *[licences.confirmed(f, licences.paragraph_words(F.col("t"))).alias(n) for n, f in (("any", None), ("mpl", F.lit("mpl")))]).collect()
    def expected(line, names):
        mine = set(licences._template_trigrams(line)) - {""}
        sets = [set(licences._template_trigrams(t)) for n in names for t in licences.TEMPLATES[n]]
        return any(len(mine & t) >= max(min(len(mine), len(t)) * licences.LEAST_OVERLAP, min(len(t) / 2, licences.LEAST_COMMON)) for t in sets)
    for r in got:
        assert bool(r["any"]) == expected(r.t or "", licences.TEMPLATES) and bool(r["mpl"]) == expected(r.t or "", ["mpl"]), r.t
    assert [bool(r["any"]) for r in got[:5]] == [False, False, False, False, True]


def test_licence_training_sees_every_ordinary_paragraph(spark):
    """Ordinary paragraphs train or calibrate wherever they stand and however many they are."""
    near = "permission is hereby granted free of cost"
    frame = spark.createDataFrame([(i, f"first line\n{near} {i}\nlast line", "x") for i in range(2500)] + [(9000, None, "x"), (None, "", "x")],
                                  "doc_id long, text string, family string")
    lines = licences.candidates(frame)
    assert lines.where("ordinary").count() == 2500 and 1000 < lines.where("calibrates").count() < 1500
    asked = frame.where("doc_id = 7").select(licences.paragraph_words(F.lit(near)).alias("words"))
    classifier = licences.train(frame)
    # trained on first and last lines alone, the model gave it 0.24 for a licence
    assert [r.probability < 0.01 for r in classifier.scored(asked).collect()] == [True]
    assert classifier.confidence == licences.LEAST_CONFIDENCE


def test_plan_of_a_mix_does_not_hold_the_earlier_attempts(spark):
    """Documents settled in one attempt are read back in the next, not joined anew in the plan of each that follows."""
    rnd = random.Random(4)
    frame = spark.createDataFrame([(k, "w " * (rnd.choice([900, 2000, 3500]) if k < 6 else rnd.choice([170, 430])), "ab"[k % 2]) for k in range(24)],
                                  "doc_id long, text string, source string")
    plan = mixing.mix(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("attempt") > 4 and plan.count("LeftSemi") == 0
