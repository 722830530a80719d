"""The training-data operators against brute force, on small tables with nulls, ties, empty and repeated rows."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curata.llm import anchors, bpe, chat, decontaminate, jaccard, license_scan, line_dedup, quality, sharding, substring_dedup, suffix_dedup
from curata.llm.common import text_buffer, words_of
from curata.llm.op9_bpe import default_vocabulary

SPACE = " \t\n\x0b\x0c\r"
DOCS = "doc_id bigint, text string, lang string, n_words string, kept string"  # the last two clash with results


def words(text):
    out, word = [], ""
    for c in text + " ":
        if c in SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def corpus(seed, n=60, repeat=True):
    """Random texts with copies, near copies, shared passages, nulls and odd white space."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts = []
    for i in range(n):
        kind = rng.random()
        own = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        if kind < 0.2 and texts:
            text = rng.choice(texts) or ""
            own = words(text)
            for _ in range(rng.randint(0, 2)):
                if own:
                    own[rng.randrange(len(own))] = rng.choice(vocabulary)
            text = text if rng.random() < 0.4 else " ".join(own)
        elif kind < 0.4:
            text = " ".join(own[:20]) + "\n" + passage + rng.choice(["\n", " ", "\t\t"]) + " ".join(own[20:])
        else:
            text = rng.choice([" ", "\n"]).join(own)
        texts.append(text)
    texts[3], texts[4], texts[5] = None, "", " \n\t"
    rows = [(i * 3, t, "en", "x", "y") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, rows[0]] if repeat else rows


def by_id(df, *columns):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], tuple(r[c] for c in columns))
    return out


# ---------------------------------------------------------------- quality rules


def test_quality(spark):
    rows = [*corpus(1), (900, "One two three. " * 40, "en", "", ""), (901, "Good words here, all of them plain and kept well.\n" * 1 + "Another line of plain words that ends as it should.\n" * 7, "en", "", ""), (902, "a | b | c | d\n" * 20, "en", "", "")]
    got = by_id(quality.judged(spark.createDataFrame(rows, DOCS)), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for i, text, *_ in rows:
        w = words(text or "")
        grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        repeated = len({k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)})
        full = [x for x in (text or "").split("\n") if x.strip(SPACE)]
        assert got[i] == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(full) - len(set(full)), repeated, len(w) < 50 or 100 * repeated > 50 * len(w)), i


def test_quality_verdicts(spark):
    good = "\n".join(" ".join(f"word{i}x{j}" for j in range(14)) + "." for i in range(6))
    cases = {1: (good, True), 2: (good + "\nAll rights reserved.", True), 3: ("\n".join(f"menu{i} | home{i} | about{i} | more{i}" for i in range(30)), False), 4: ("\n".join(f"WORD{i}!! LOUD{i}!! CRY{i}!!" for i in range(30)), False), 5: (None, False)}
    df = quality.judged(spark.createDataFrame([(i, t) for i, (t, _) in cases.items()], "doc_id bigint, text string"))
    got = by_id(df, "kept", "clean_text")
    assert {i: v[0] for i, v in got.items()} == {i: k for i, (_, k) in cases.items()}
    assert got[2][1] == good
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


# ---------------------------------------------------------------- dedup


def test_suffix_dedup(spark):
    rows = [(i, t) for i, t, *_ in corpus(2)] + [(None, "x" * 450), (7000, "ab" * 300), (7001, "é" * 150)]
    window = 200
    count = Counter(b[k : k + window] for b in ((t or "").encode() for _, t in rows) for k in range(len(b) - window + 1))
    got = by_id(suffix_dedup.removed(spark.createDataFrame(rows, "doc_id bigint, text string"), window), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert len(got) == len({i for i, _ in rows})
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - window + 1):
            if count[b[k : k + window]] > 1:
                gone[k : k + window] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        assert got[i] == (len(b), int(gone.sum()), runs, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())), i


def expected_windows(rows, window):
    first = {}
    for i, t in rows:
        w = words(t or "")
        if i is not None:
            for k in range(len(w) - window + 1):
                g = tuple(w[k : k + window])
                first[g] = min(first.get(g, i), i)
    out = {}
    for i, t in rows:
        w = words(t or "")
        gone = {k + j for k in range(len(w) - window + 1) if i is not None and first[tuple(w[k : k + window])] < i for j in range(window)}
        out[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_substring_dedup(spark):
    rows = [(i, t) for i, t, *_ in corpus(3)] + [(None, corpus(3)[0][1]), (8000, "a a " * 40), (8001, "a " * 30), (8002, "b c d " * 20)]
    got = by_id(substring_dedup.removed(spark.createDataFrame(rows, "doc_id bigint, text string"), 13), "n_words", "n_removed", "kept_sha256")
    assert got == expected_windows(rows, 13)


@pytest.mark.parametrize("hot", [1, 3])
def test_hot_anchors(spark, monkeypatch, hot):
    monkeypatch.setattr(anchors, "HOT_RUNS", hot)
    test_substring_dedup(spark)
    test_suffix_dedup(spark)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert suffix_dedup.removed(none).count() == substring_dedup.removed(none).count() == jaccard.classes(none).count() == 0
    assert line_dedup.drop_lines(none).count() == quality.judged(none).count() == license_scan.scan(none).count() == sharding.assign(none, 10).count() == 0
    items = spark.createDataFrame([(1, "some words")], "item_id bigint, text string")
    assert decontaminate.leaks(none, items).count() == decontaminate.leaks(none, items.limit(0)).count() == 0
    assert chat.format_conversations(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0
    assert bpe.digests(none, default_vocabulary()).count() == 0


def test_difference_cover():
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))


def test_narrowing_parts_the_windows():
    rng = random.Random(15)
    for _ in range(300):
        window = rng.randint(4, 30)
        fa = rng.randint(0, 20)
        fb = fa + rng.randint(1, window)
        size = max(fb, rng.randint(window, 60))
        first, last = max(0, fb - window), min(fa, size - window)
        if first > last or size < window:
            continue
        piece, fa, fb = bytes(last + window - first), fa - first, fb - first  # every window of the piece holds [fa, fb)
        seen = []
        for _, low, high, a, z in suffix_dedup.narrower(piece, fa, fb, window):
            assert z - a > fb - fa and (z - a) - (fb - fa) >= (window - (fb - fa)) // 2
            seen += range(low, high - window + 1)
            assert all(s <= a and z <= s + window for s in range(low, high - window + 1))
        assert sorted(seen) == (list(range(len(piece) - window + 1)) if fb - fa < window else [])


def brute_parse(text, reference):
    """Greedy factors (start, end) by looking at every place of the reference."""
    out, i = [], 0
    while i < len(text):
        best = 0
        for j in range(len(reference)):
            n = 0
            while i + n < len(text) and j + n < len(reference) and text[i + n] == reference[j + n]:
                n += 1
            best = max(best, n)
        out.append((i, i + max(1, best)))
        i = out[-1][1]
    return out


def test_parsing():
    rng = random.Random(16)
    for _ in range(150):
        letters = [bytes([97 + k]) for k in range(rng.randint(1, 4))]
        draw = lambda n: [rng.choice(letters) for _ in range(rng.randint(0, n))]  # noqa: E731, B023
        groups = [(draw(40), [draw(30) for _ in range(rng.randint(0, 4))]) for _ in range(rng.randint(1, 4))]
        parser, number = substring_dedup.Parser(groups), 0
        for reference, stretches in groups:
            number += 1
            for s in stretches:
                at = int(parser.begin[number])
                lengths = parser.length[at : at + len(s)].tolist()
                assert list(substring_dedup.factors(lengths)) == brute_parse(s, reference)
                for i, n in enumerate(lengths):
                    assert n == 0 or s[i : i + n] in [reference[j : j + n] for j in range(len(reference))]
                for window in (2, 3, 7):
                    held = {tuple(reference[j : j + window]) for j in range(len(reference) - window + 1)}
                    expected = {i + k for i in range(len(s) - window + 1) if tuple(s[i : i + window]) in held for k in range(window)}
                    assert {i for a, z in substring_dedup.duplicate_spans(lengths, window) for i in range(a, z)} == expected
                number += 1


def test_factors_decide():
    """Without the copies of the parse nothing is removed; windows that two references hold are found at a factor's end."""
    text = [b"1", b"2", b"3", b"4", b"5", b"6"]
    parser = substring_dedup.Parser([([b"1", b"2", b"3", b"4", b"9", b"3", b"4", b"5", b"6"], [text])])
    at = int(parser.begin[1])
    lengths = parser.length[at : at + 6].tolist()
    assert lengths == [4, 3, 4, 3, 2, 1]
    assert list(substring_dedup.factors(lengths)) == [(0, 4), (4, 6)] and substring_dedup.duplicate_spans(lengths, 3) == [(0, 6)]
    assert substring_dedup.duplicate_spans([0] * 6, 3) == []


def test_blocks_meet_and_the_parse_finds_spans(monkeypatch):
    """What two blocks have in common is found by factoring them whole; that they meet removes nothing by itself."""
    rng = random.Random(21)
    reference = [b"r%d" % rng.randrange(10**6) for _ in range(500)]
    own = lambda n: [b"o%d" % rng.randrange(10**6) for _ in range(n)]
    later = own(30) + reference[100:140] + own(50) + reference[7:19] + own(3) + reference[480:500] + own(9)
    other = own(200)  # met by mistake
    rows = [(1, 11, 0, 0, 0, 1, 11, 0, b" ".join(reference)), (1, 11, 0, 0, 1, 2, 22, 64, b" ".join(later)), (1, 11, 0, 0, 1, 3, 33, 0, b" ".join(other))]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), substring_dedup._PIECES.types, strict=True)], schema=substring_dedup._PIECES)
    found = lambda: [tuple(r.values()) for b in substring_dedup._parsed(13)(iter([batch])) for r in b.to_pylist()]
    assert found() == [(2, 22, 64 + 30, 64 + 70), (2, 22, 64 + 135, 64 + 155)]
    monkeypatch.setattr(substring_dedup, "duplicate_spans", lambda lengths, window: [])
    assert found() == []


def test_meetings_hold_no_windows(spark):
    links = spark.createDataFrame([(1, 1, 5, 2, 2, 60, 10), (1, 1, 300_000, 2, 2, 0, 1), (1, 1, 7, 2, 2, 62, 1)], "rdoc bigint, rkey bigint, rplace bigint, doc bigint, key bigint, first bigint, n int")
    got = substring_dedup.meetings(links)
    assert got.columns == ["rdoc", "rkey", "chunk", "doc", "key", "cell"]
    assert sorted(map(tuple, got.collect())) == [(1, 1, 0, 2, 2, 0), (1, 1, 0, 2, 2, 1), (1, 1, 1, 2, 2, 0)]


def sets_of(rows, n):
    out = {}
    for i, t in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    return out


def components(sets, percent):
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x = len(sets[a] & sets[b])
            if x and 100 * x >= percent * (len(sets[a]) + len(sets[b]) - x):
                a2, b2 = find(a), find(b)
                root[max(a2, b2)] = min(a2, b2)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("percent", "n", "group"), [(85, 4, 1000), (80, 5, 1000), (80, 2, 3), (60, 1, 4)])
def test_jaccard(spark, monkeypatch, percent, n, group):
    monkeypatch.setattr(jaccard, "GROUP_DOCS", group)
    monkeypatch.setattr(jaccard, "SHARED_DOCS", 2)
    monkeypatch.setattr(jaccard, "PAIR_BLOCKS", 64 if group == 3 else 2)
    rng = random.Random(percent)
    rows = [(i, t) for i, t, *_ in corpus(4, 80)]
    base = [rng.choice("abcdefghij") * 2 + str(k) for k in range(60)]
    for k in range(30):  # a chain of near copies, and small sets
        base[k] = f"x{k}"
        rows.append((5000 + k, " ".join(base)))
        rows.append((6000 + k, " ".join(str(rng.randrange(9)) for _ in range(rng.randint(1, 8)))))
    got = by_id(jaccard.classes(spark.createDataFrame(rows, "doc_id bigint, text string"), percent, n), "n_shingles", "component_id")
    assert got == components(sets_of(rows, n), percent)


def test_jaccard_of_repeated_ids(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    rows = [(1, text("a")), (2, text("b") + " more"), (3, text("a") + " more"), (3, text("c")), (4, text("c")), (5, text("d")), (6, text("b")), (6, text("b")), (None, text("a")), (7, text("e")), (7, None)]
    got = jaccard.classes(spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as component_id"), 85, 4).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (3, 1), (4, 1), (2, 2), (6, 2), (5, 5), (7, 7), (None, None)}


def test_prefix_tree():
    rng = random.Random(5)
    for _ in range(60):
        sets = [np.array(sorted(rng.sample(range(30), rng.randint(1, 14))), np.uint64) for _ in range(25)]
        for percent in (50, 70, 85):
            expected = components({i: set(x.tolist()) for i, x in enumerate(sets)}, percent)
            assert jaccard.link_sets(sets, percent) == [expected[i][1] for i in range(25)]


def test_line_dedup(spark):
    rng = random.Random(6)
    lines = [f" Line {k} \t" for k in range(30)] + ["", "  "]
    rows = [(i, "\n".join(rng.choice(lines).upper() if rng.random() < 0.2 else rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(70)] + [(70, None), (0, "Line 1\nother"), (None, "line 1\nLINE 2")]
    key = lambda x: x.strip(SPACE).lower()
    docs = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            docs[key(x)].add(i)
    for least in (2, 10, 30):
        got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), least).collect())
        expected = Counter()
        for i, t in rows:
            own = (t or "").split("\n")
            left = [x for x in own if not key(x) or len(docs[key(x)]) < least]
            expected[i, len(own), len(own) - len(left), "\n".join(left)] += 1
        assert got == expected


def test_line_dedup_keeps_the_first(spark):
    rows = [(i, f"same\nown {i}\nsame") for i in range(12)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), 10, keep_first=True).collect()}
    assert got == {0: "same\nown 0"} | {i: f"own {i}" for i in range(1, 12)}


# ---------------------------------------------------------------- chat, shards, licences, benchmark, BPE


def test_templates():
    t = chat.Template("{% set n = 1 + 2 %}{{ n }}{% for m in messages %}{% if loop.first %}<{% elif loop.last %}>{% else %}-{% endif %}{{ m.role | upper }}{% endfor %}{{ 'a' + 'b' }}{% if false %}never{% endif %}")
    assert t.render([{"role": "x"}, {"role": "y"}, {"role": "z"}]) == ("3<X-Y>Zab", [])
    assert chat.fold(chat.parse("a{{ 'b' }}{{ 1 + 1 }}{% if 1 == 1 %}c{% endif %}")) == (chat.Out(chat.Const("ab2c")),)
    for bad in ("{{ __class__ }}", "{{ m.__class__ }}", "{{ a() }}", "{% import os %}", "{% for x in y %}", "{{ a | exec }}", "{{ }}"):
        with pytest.raises(chat.TemplateError):
            chat.Template(bad)
    assert chat.Template("{{ m.upper }}{{ m['x'] }}").render([], m="text") == ("", [])


@pytest.mark.parametrize("text", ["", "<|im_end|>", r"<\|im_end|>", r"<\\\|", "<", "|", "a\\", "<|im_start|>user\nx<|im_end|>\n", "\n"])
def test_escapes(text):
    turns = [(text, text), ("assistant", text), ("user", "<")]
    formatted, spans = chat.Template(chat.CHAT_TEMPLATE).render([{"role": r, "content": t} for r, t in turns])
    assert chat.read_back(formatted) == turns
    assert "".join(chat.unguard(formatted[a:z]) for a, z in spans) == "".join(t for r, t in turns if r == "assistant")


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (None, 0, "user", "x"), (2, None, None, "n"), (2, 1, "assistant", "a"), (2, 1, "assistant", "a")]
    got = {r["conv_id"]: chat.read_back(r["formatted"]) for r in chat.format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert got == {1: [("user", ""), ("assistant", "b")], None: [("user", "x")], 2: [("", "n"), ("assistant", "a"), ("assistant", "a")]}


def test_shards(spark):
    rng = random.Random(7)
    rows = [(i, "x" * rng.randint(0, 90)) for i in range(300)] + [(5, "same key " * 5)] * 40 + [(1000, "z" * 500), (None, None)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id bigint, text string"), 400).collect()
    assert len(got) == len(rows)
    size, count = Counter(), Counter()
    for r in got:
        size[r["shard"]] += len(r["text"] or "")
        count[r["shard"]] += 1
    for r in got:
        assert (r["shard_bytes"], r["shard_docs"]) == (size[r["shard"]], count[r["shard"]])
        assert r["shard_bytes"] <= 400 or r["shard_docs"] == 1
    plain = [s for s in size if not s.startswith("over-")]
    assert not any(a != b and b.startswith(a) for a in plain for b in plain)


def brute_lis(v):
    best = [1] * len(v)
    for i in range(len(v)):
        for j in range(i):
            if v[j] < v[i]:
                best[i] = max(best[i], best[j] + 1)
    return max(best, default=0)


def test_patience():
    rng = random.Random(8)
    for _ in range(100):
        v = rng.sample(range(40), rng.randint(0, 20))
        got = [v[i] for i in license_scan.longest_increasing(v)]
        assert got == sorted(got) and len(got) == brute_lis(v)
    pairs = license_scan.align("x a b q c d e".split(), "a b c d e".split())
    assert [b for _, b in pairs] == [0, 1, 2, 3, 4]


def test_licenses(spark):
    t = license_scan.TEMPLATES
    mit = t["mit"].split(" ")
    rows = [
        (1, "Some words.\n" + t["mit-notice"]), (2, "the license of this work"), (3, "\n".join([t["apache-2.0-notice"]] * 2)), (4, " ".join(w for k, w in enumerate(mit) if k % 12)), (5, " ".join(mit[: len(mit) // 2])),
        (6, None), (7, ""), (8, "word " * 20_000 + t["all-rights-reserved"].upper()), (9, " ".join(t["mit-grant"].split(" ")[:44])),
    ]
    got = {(r["doc_id"], r["license"]): (r["n_found"], r["end_word"]) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert set(got) == {(1, "mit-notice"), (3, "apache-2.0-notice"), (4, "mit"), (4, "mit-grant"), (5, "mit-grant"), (8, "all-rights-reserved")}
    assert got[3, "apache-2.0-notice"][0] == 2 and got[8, "all-rights-reserved"] == (1, 20_003)


def license_rows(spark, texts):
    return {(r["doc_id"], r["license"]): r for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}


def test_licenses_after_telling_words(spark):
    names = list(license_scan.TEMPLATES)
    notices = [license_scan.TEMPLATES[n] for n in names]
    leads = ["Copyright (c) 2020 Jane Doe\n", "MIT License. This software, its license and copyright notice: the Software Foundation. ", "Licensed, the License. "]
    texts = [lead + notice for lead in leads for notice in notices] + [notices[5][:200] + " (the software, a copy, the license) " + notices[5][200:]]
    got = license_rows(spark, texts)
    for i, text in enumerate(texts):
        name = names[i % len(names)] if i < 3 * len(names) else names[5]
        template = license_scan.words(license_scan.TEMPLATES[name])
        row = got[i, name]
        assert row["n_paired"] >= len(license_scan.align(license_scan.words(text), template)) and row["n_found"] >= 1, name
        if i < 3 * len(names):
            assert row["n_paired"] == len(template), (name, text)


def test_licenses_under_headings(spark):
    notice, mit = license_scan.TEMPLATES["apache-2.0-notice"], license_scan.TEMPLATES["mit"]
    texts = [f"License\n\n{notice}", f"License: {notice}", f"This is version 2 of the library. {notice}", notice.replace("the Apache", "the the Apache"), f"# MIT License\n\nCopyright (c) 2020 Jane Doe\n\n{mit}", "\n".join(" * " + mit[k : k + 70] for k in range(0, len(mit), 70))]
    got = license_rows(spark, texts)
    for k in range(4):
        assert got[k, "apache-2.0-notice"]["n_paired"] == 8, texts[k]
    assert got[4, "mit"]["n_paired"] == len(license_scan.words(mit)) and got[5, "mit"]["n_found"] == 1


def brute_align(text, template):
    """The patience alignment's pairs, by recursion on lists."""
    if not text or not template:
        return []
    if text[0] == template[0]:
        return [(0, 0)] + [(i + 1, j + 1) for i, j in brute_align(text[1:], template[1:])]
    if text[-1] == template[-1]:
        return [*brute_align(text[:-1], template[:-1]), (len(text) - 1, len(template) - 1)]
    unique = [(text.index(w), j) for j, w in enumerate(template) if template.count(w) == 1 and text.count(w) == 1]
    kept = [unique[k] for k in license_scan.longest_increasing([i for i, _ in unique])]
    if not kept:
        return license_scan.common(text, template)
    out, a, c = [], 0, 0
    for i, j in [*kept, (len(text), len(template))]:
        out += [(a + x, c + y) for x, y in brute_align(text[a:i], template[c:j])]
        if i < len(text):
            out.append((i, j))
        a, c = i + 1, j + 1
    return out


def test_alignment_by_recursion():
    rng = random.Random(19)
    for _ in range(400):
        template = [rng.randrange(9) for _ in range(rng.randint(0, 10))]
        text = [rng.randrange(11) for _ in range(rng.randint(0, 25))]
        assert license_scan.align(text, template) == brute_align(text, template)


def brute_places(text, template, least, needed):
    """By the words of the rule: every window, aligned by recursion; the best places without overlap."""
    n, found = len(template), []
    for size, step in ((12, 4), (8, 2), (5, 1)):
        width, step = math.ceil(size * n / 4), max(1, step * n // 4)
        starts = [a for a in range(0, max(1, len(text)), step) if a == 0 or a - step + width < len(text)]
        for a in starts:
            window = text[a : a + width]
            pairs = brute_align(window, template)
            if len(pairs) >= least and set(needed) <= {template[j] for _, j in pairs}:
                inside = window[pairs[0][0] : pairs[-1][0] + 1]
                if not any(w in license_scan.QUALIFIERS and w not in template for w in inside):
                    found.append((len(pairs), a + pairs[0][0], a + pairs[-1][0] + 1))
    out = []
    for p in sorted(set(found), key=lambda p: (-p[0], p[2] - p[1], p[1])):
        if not any(p[1] < q[2] and q[1] < p[2] for q in out):
            out.append(p)
    return out


def test_licenses_of_a_whole_table(spark):
    """The query's rows against a scan that aligns every window of every text by recursion."""
    from curata.llm import queries

    sf = "/root/testdata/sf0.001"
    expected, order = {}, list(license_scan.TEMPLATES)
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        text, held = license_scan.words(r["text"] or ""), {}
        for name, source in license_scan.TEMPLATES.items():
            template = license_scan.words(source)
            least = -(-4 * len(template) // 5)
            if sum((Counter(text) & Counter(template)).values()) >= least and (own := brute_places(text, template, least, license_scan.OBLIGATORY.get(name, ()))):
                held[name] = own
        rank = lambda name, p: (p[0], p[0] / len(license_scan.words(license_scan.TEMPLATES[name])), -order.index(name))
        for name, own in held.items():
            wholes = [max([(rank(m, q), m) for m, more in held.items() for q in more if m != name and q[1] < p[2] and p[1] < q[2] and rank(m, q) > rank(name, p)], default=(0, None))[1] for p in own]
            expected[r["doc_id"], name] = (*own[0], len(own), wholes[0] if None not in wholes else None)
    got = {(r["doc_id"], r["license"]): (r["n_paired"], r["first_word"], r["end_word"], r["n_found"], r["part_of"]) for r in queries.queries()["op10_licenses"](spark, sf).collect()}
    assert got == expected and len(expected) > 3


def test_each_template_is_itself_alone(spark):
    """One licence a notice: its own; others only as parts of it."""
    names = list(license_scan.TEMPLATES)
    got = license_rows(spark, [license_scan.TEMPLATES[n] for n in names])
    for i, name in enumerate(names):
        assert [n for (k, n), r in got.items() if k == i and r["part_of"] is None] == [name]
    assert got[names.index("mit"), "mit-grant"]["part_of"] == "mit" and got[names.index("bsd-3-clause"), "bsd-2-clause"]["part_of"] == "bsd-3-clause"


def test_words_that_make_another_licence(spark):
    t = license_scan.TEMPLATES
    texts = [
        "Licensed under the EPL License, Version 2.0.", "Licensed under CC BY-SA 4.0.", "Licensed under CC BY-NC-ND 4.0.", t["gpl-3.0-notice"].replace("General", "Lesser General"), t["gpl-3.0-notice"].replace("3", "2"), "Released under the BSD License.",
        t["cc-by-4.0"].replace("Attribution", "Attribution-NoDerivatives"), t["gpl-2.0"].replace("version 2", "version 9"), t["lgpl-2.1"].replace("2.1", "3"), t["mit-notice"] + " " + t["apache-2.0-notice"],
    ]
    got = license_rows(spark, texts)
    assert set(got) == {(9, "mit-notice"), (9, "apache-2.0-notice")} and all(r["part_of"] is None for r in got.values())


def test_nothing_is_found_without_alignment(monkeypatch):
    texts = [license_scan.TEMPLATES["mit"], "Some words. " + license_scan.TEMPLATES["mit-notice"]]
    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8, license_scan.OBLIGATORY)
    raw = [t.encode() for t in texts]
    numbers = scanner.number(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert list(scanner.scan(*numbers))
    monkeypatch.setattr(license_scan, "align", lambda text, template: [])
    assert list(scanner.scan(*numbers)) == []


def brute_common(text, template):
    best = [0] * (len(template) + 1)
    for x in text:
        before = best[:]
        for j, y in enumerate(template):
            best[j + 1] = before[j] + 1 if x == y else max(before[j + 1], best[j])
    return best[-1]


def test_common_subsequence_and_places():
    rng = random.Random(13)
    for _ in range(400):
        template = [rng.randrange(6) for _ in range(rng.randint(1, 8))]
        text = [rng.randrange(8) for _ in range(rng.randint(0, 40))]
        pairs = license_scan.common(text, template)
        assert len(pairs) == brute_common(text, template) and all(text[i] == template[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
        least, needed = rng.randint(1, len(template)), [template[0]] * rng.randrange(2)
        assert license_scan.places(text, template, least, needed) == brute_places(text, template, least, needed)


def test_licenses_in_long_texts_and_odd_columns(spark):
    """A notice at the end of a text of some megabytes; columns that have the names of results."""
    long = "the license of this software and its version " * 60_000 + license_scan.TEMPLATES["mit-notice"]
    df = spark.createDataFrame([(1, long, "x"), (None, license_scan.TEMPLATES["cc-by-4.0"], "y")], "doc_id bigint, text string, License string").selectExpr("*", "1 as part_of", "2 as `a.b`")
    got = {(r["doc_id"], r["license"]): (r["end_word"], r["n_found"]) for r in license_scan.scan(df).where("part_of is null").collect()}
    assert got == {(1, "mit-notice"): (8 * 60_000 + 5, 1), (None, "cc-by-4.0"): (13, 1)}


def test_block_max_wand():
    rng = random.Random(9)
    items = [(i, " ".join(f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randint(0, 25)))) for i in range(90)]
    df, total = Counter(), 0
    for _, t in items:
        raw = np.frombuffer(t.encode(), np.uint8)
        h = decontaminate.hashed_words(raw, np.array([0, len(raw)]))[0]
        df.update(set(h.tolist()))
        total += len(h)
    index = decontaminate.Index(items, df, len(items), total / len(items))
    for _ in range(300):
        query = rng.sample(range(len(index.words)), rng.randint(1, 40))
        scores = Counter()
        for w in query:
            for i, x in zip(index.items[w], index.impacts[w], strict=True):
                scores[i] += x
        for threshold in (0.05, 0.3, 0.6):
            got = index.search(query, threshold)
            assert set(got) == {i for i, s in scores.items() if s >= threshold - 1e-9}
            assert all(abs(got[i] - scores[i]) < 1e-9 for i in got)


def test_leaks(spark):
    rng = random.Random(10)
    vocabulary = [f"{a}{b}" for a in "bcdfg" for b in range(60)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(20) + ". " + text(8) + ".") for k in range(30)] + [(30, None), (31, ""), (0, "Twice " + text(20))]
    rows, expected = [], set()
    for i in range(120):
        body = text(rng.choice([0, 5, 90, 400]))
        if i % 3 == 0:
            k = rng.randrange(30)
            at = rng.randrange(len(body.split(" ")) + 1)
            parts = body.split(" ")
            body = " ".join([*parts[:at], items[k][1].upper() if i % 2 else items[k][1], *parts[at:]])
            expected.add((i, k))
        elif i % 3 == 1:
            body += " " + items[i % 30][1].split(".")[0]  # the question alone
        rows.append((i, body))
    rows += [(500, None), rows[0]]
    make = lambda r, c: spark.createDataFrame(r, f"{c} bigint, text string")
    got = decontaminate.leaks(make(rows, "doc_id"), make(items, "item_id")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected and len(got) == len(expected)
    blocks = list(decontaminate.indexes(make(items, "item_id"), block_bytes=1500))
    assert len(blocks) > 1 and sorted(i for b in blocks for i in b.ids) == sorted([*range(30), 0])


def test_leaks_of_items_without_id(spark):
    texts = ["the first question has some words of its own. and an answer", "what is asked here. nothing at all, it seems"]
    items = spark.createDataFrame([(None, texts[0]), (7, texts[1]), (None, None), (None, "")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"before {texts[0]} after"), (2, f"before {texts[1]} after"), (3, "neither")], "doc_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()} == {(1, None), (2, 7)}


def test_leaks_beside_long_items(spark):
    rng = random.Random(14)
    vocabulary = [f"w{k}" for k in range(2000)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    short = [draw(20) for _ in range(12)]
    long = {100: draw(90), 101: draw(900)}
    texts = {k: " ".join(x[:14]) + ". " + " ".join(x[14:]) + "." for k, x in enumerate(short)} | {k: " ".join(x[: len(x) // 2]) + ". " + " ".join(x[len(x) // 2 :]) + "." for k, x in long.items()}
    docs = {}
    for k, x in enumerate(short):  # the item's words far apart, and the item at some place
        spread = draw(1600)
        for j, w in enumerate(x):
            spread[j * 80] = w
        docs[k] = " ".join(spread)
        at = rng.randrange(700)
        docs[50 + k] = " ".join(draw(at)) + " " + texts[k] + " " + " ".join(draw(700 - at))
    docs |= {200 + at: " ".join([*draw(at), texts[101], *draw(300)]) for at in (0, 37, 511, 899, 1500)}
    docs |= {5000 + at: " ".join([*draw(at), texts[100], *draw(40)]) for at in (0, 89, 127, 128, 200)}
    expected = {(50 + k, k) for k in range(12)} | {(200 + at, 101) for at in (0, 37, 511, 899, 1500)} | {(5000 + at, 100) for at in (0, 89, 127, 128, 200)}
    table = lambda rows, c: spark.createDataFrame(list(rows.items()), f"{c} bigint, text string")
    found = decontaminate.leaks(table(docs, "doc_id"), table(texts, "item_id")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected
    # brute force: each item's own passages
    index = decontaminate.Index([(k, x) for k, x in texts.items()], *brute_statistics(texts.values()))
    brute = {}
    for d, text in docs.items():
        h = decontaminate.hashed_words(*text_buffer(pa.array([text])))[0]
        for i, item in enumerate(index.ids):
            half = max(64, len(words(texts[item])))
            for a in range(0, len(h), half):
                here = set(h[a : a + 2 * half].tolist())
                score = sum(x for w, x in index.own[i].items() if w in here)
                question, answer = (sum(w in here for w in part.tolist()) / len(part) for part in (index.question[i], index.answer[i]))
                if score >= 0.6 - 1e-9 and min(question, answer) >= 0.8:
                    brute[d, item] = max(brute.get((d, item), (0, 0, 0)), (score, question, answer))
    assert {(r["doc_id"], r["item_id"]): pytest.approx((r["score"], r["question_overlap"], r["answer_overlap"])) for r in found} == brute


def brute_statistics(texts):
    df, total = Counter(), 0
    for text in texts:
        h = decontaminate.hashed_words(*text_buffer(pa.array([text])))[0]
        df.update(set(h.tolist()))
        total += len(h)
    return df, len(texts), total / len(texts)


def test_bpe(spark):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(default_vocabulary())
    rng = random.Random(11)
    letters = "abcdefgh  \n\t.,'’éßñ漢字🙂\x1c\x85\xa0 123²½Яж<|endoftext|>!!##"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["", "a" * 5000, " " * 3000, "<|endoftext|><|endoftext|>x", "We'll see: don't!", "\r\n\r\n x"]
    rows = [*enumerate(texts), (900, None), (900, None)]
    df = spark.createDataFrame(rows, "token_ids bigint, text string").withColumnRenamed("token_ids", "doc_id").withColumn("n_tokens", F.lit("x"))
    got = by_id(bpe.digests(df, default_vocabulary()), "n_tokens", "ids_sha256", "decoded_sha256")
    for i, t in rows:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        assert got[i] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(reference.decode(ids, skip_special_tokens=False))), (i, t)
    back = bpe.decode(bpe.encode(df, default_vocabulary()), default_vocabulary()).where("doc_id < 900")
    assert {r["doc_id"]: r["decoded"] for r in back.collect()} == dict(enumerate(texts))


# ---------------------------------------------------------------- shared parts


def test_buffers_and_words():
    texts = ["a b", None, "", " é\tc ", "x\x0by"]
    data, offsets = text_buffer(pa.array(texts).slice(1))
    start, end, at = words_of(data, offsets)
    assert [bytes(data[a:z]).decode() for a, z in zip(start, end, strict=True)] == ["é", "c", "x", "y"] and at.tolist() == [0, 0, 0, 2, 4]


def test_runs_cover_every_window_once():
    rng = random.Random(12)
    for _ in range(40):
        sizes = [rng.randint(0, 60) for _ in range(8)]
        data = np.array([rng.choice([97, 97, 98]) for _ in range(sum(sizes))], np.uint8)
        offsets = np.cumsum([0, *sizes])
        (runs,) = list(suffix_dedup.byte_runs(20)(data, offsets))
        covered = [(d, k) for d, a, z in zip(runs.doc, runs.first, runs.end, strict=True) for k in range(a, z)]
        assert covered == [(d, k) for d in range(8) for k in range(offsets[d], offsets[d + 1] - 19)]
        # equal windows have equal anchors at equal places
        where = defaultdict(set)
        for a, z, at, h in zip(runs.first, runs.end, runs.at, runs.h, strict=True):
            for k in range(a, z):
                where[data[k : k + 20].tobytes()].add((at - k, int(h)))
        assert all(len(v) == 1 for v in where.values())
