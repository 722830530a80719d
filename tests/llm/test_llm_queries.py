"""The registered queries of the training-data operators against their SQL, and the pipeline end to end."""

import math
import re
from collections import Counter

import pytest
import regex
from oracle import both

import corpus_pipeline
from curata.llm import decontaminate, quality, queries
from curata.llm.op9_bpe import default_vocabulary

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    ours, theirs = both(spark, SF, queries.queries()[name], queries.oracle_sql()[name])
    assert ours == theirs


def plain_words(text):
    """Runs of letters and digits, where all that isn't ASCII counts as a letter; A-Z lower-cased."""
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text))


def brute_leaks(docs, items, threshold=0.6, least=0.8):
    """Every passage of every document against every item, by BM25 as written down in textbooks."""
    split = [(i, plain_words(t or "")) for i, t in items]
    split = [(i, w, t) for (i, w), (_, t) in zip(split, items, strict=True) if w]
    df = Counter(x for _, w, _ in split for x in set(w))
    mean = sum(len(w) for _, w, _ in split) / len(split)
    out = {}
    for item, w, text in split:
        tf = Counter(w)
        impact = {x: math.log(1 + (len(split) - df[x] + 0.5) / (df[x] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(w) / mean)) for x, n in tf.items()}
        total = sum(impact.values())
        places = [m.span() for m in re.finditer(r"[A-Za-z0-9\x80-\U0010ffff]+", text)]
        cut = next((k for k in range(len(w) - 1, 0, -1) if any(c in ".!?\n" for c in text[places[k - 1][1] : places[k][0]])), len(w) - max(1, len(w) // 3) if len(w) > 1 else 0)
        question, answer, half = set(w[:cut]), set(w[cut:]), max(64, len(w))
        for doc, words in docs:
            for a in range(0, len(words), half):
                here = set(words[a : a + 2 * half])
                score = sum(v for x, v in impact.items() if x in here) / total
                overlaps = [len(p & here) / len(p) if p else 1.0 for p in (question, answer)]
                if score >= threshold - 1e-9 and min(overlaps) >= least:
                    out[doc, item] = max(out.get((doc, item), (0, 0, 0)), (score, *overlaps))
    return out


def test_leaks_of_whole_tables(spark):
    docs = [(r["doc_id"], plain_words(r["text"] or "")) for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{LARGER}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]): pytest.approx((r["score"], r["question_overlap"], r["answer_overlap"])) for r in queries.queries()["op6_decontamination"](spark, LARGER).collect()}
    expected = brute_leaks(docs, items)
    assert got == expected and len(expected) > 5


@pytest.mark.parametrize("block_bytes", [3000, 1 << 22])
def test_leaks_by_block_size(spark, monkeypatch, block_bytes):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = {tuple(r[:2]) for r in decontaminate.leaks(docs, items).collect()}
    own = decontaminate.index_blocks
    monkeypatch.setattr(decontaminate, "index_blocks", lambda a, b, c: own(a, b, c, block_bytes))
    monkeypatch.setattr(decontaminate, "BOUNDS", 7)
    odd = docs.selectExpr("*", "1 as item_id", "2 as score", "3 as `a.b`")
    assert {tuple(r[:2]) for r in decontaminate.leaks(odd, items).collect()} == expected


SPACE = " \t\n\x0b\x0c\r"
NOTICE = regex.compile(quality.BOILERPLATE, regex.I)
SENTENCE = regex.compile(quality.SENTENCE_END)


def plain_quality(text):
    """The text without failing lines, None where the document is rejected."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    repeated = len({k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)})
    kept, lost = [], 0
    for line in text.split("\n"):
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        n = len(own)
        fails = n and (
            10 * sum(c in quality.SYMBOLS for c in line) > len(line) or line.count("|") >= 3 or len(line) - len(line.replace("!!", "!")) >= 3
            or (n < quality.NOTICE_WORDS and bool((n < 10 and not SENTENCE.search(line)) or NOTICE.search(line)))
        )
        if fails:
            lost += sum(map(len, own))
        else:
            kept.append(line)
    rejected = len(words) < 50 or 100 * repeated > 50 * len(words) or lost > 0.5 * sum(map(len, words))
    return None if rejected else "\n".join(kept)


def plain_line_dedup(rows):
    """rows (doc_id, text): of a line in ten documents or more the first stays; documents without a word go."""
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(SPACE))
    docs, first = {}, {}
    for i, t in sorted(rows):
        for k, x in enumerate(t.split("\n")):
            if key(x):
                docs.setdefault(key(x), set()).add(i)
                first.setdefault(key(x), (i, k))
    out = []
    for i, t in rows:
        left = [x for k, x in enumerate(t.split("\n")) if not key(x) or len(docs[key(x)]) < 10 or first[key(x)] == (i, k)]
        if any(x.strip(SPACE) for x in left):
            out.append((i, "\n".join(left)))
    return out


def plain_near_duplicates(rows):
    """rows (doc_id, text): of those linked by 0.8 of their five-word shingles the smallest doc_id stays."""
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    gone, ids = {i: i for i in sets}, sorted(sets)

    def find(x):
        while gone[x] != x:
            x = gone[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                gone[y] = x
    return [(i, t) for i, t in rows if find(i) == i]


def test_pipeline_by_brute_force(spark):
    """Each stage's rows, and the rows of run(), against plain Python over the whole table."""
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(default_vocabulary())
    table = spark.read.parquet(f"{SF}/documents.parquet").collect()
    more = {r["doc_id"]: (r["lang"], r["source"]) for r in table}
    assert len(more) == len(table)
    rows = [(r["doc_id"], t) for r in table if (t := plain_quality(r["text"] or "")) is not None]
    expected = [rows]
    expected.append(rows := plain_line_dedup(rows))
    expected.append(rows := plain_near_duplicates(rows))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d, _ in brute_leaks([(i, plain_words(t)) for i, t in rows], items)}
    expected.append(rows := [(i, t) for i, t in rows if i not in leaks])
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = corpus_pipeline.written(stage(spark, docs, SF), f"test-{k}")
        assert docs.columns == corpus_pipeline.COLUMNS
        got = docs.collect()
        assert sorted((r["doc_id"], r["text"]) for r in got) == sorted(expected[k]), k
        assert all((r["lang"], r["source"], r["n_chars"]) == (*more[r["doc_id"]], len(r["text"])) for r in got)
    assert [len(table), *map(len, expected)] == sorted([len(table), *map(len, expected)], reverse=True) and len(expected[-1]) > 0.5 * len(table)
    ids = {i: reference.encode(t, add_special_tokens=False).ids for i, t in rows}
    run = {r["doc_id"]: tuple(r[c] for c in ("lang", "source", "n_tokens", "round_trip", "token_ids")) for r in corpus_pipeline.run(spark, SF).collect()}
    assert run == {i: (*more[i], len(x), True, x) for i, x in ids.items()}


def test_stages_on_odd_rows(spark):
    text = "Plain words make this line, and it ends as it should.\n" * 2 + " ".join(f"word{i}" for i in range(80)) + "."
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0), (None, text + " more", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.selectExpr("*", "1 as kept", "2 as component_id", "3 as n_lines")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.written(stage(spark, docs, SF), f"odd-{k}")
    assert sorted(r["doc_id"] or 0 for r in docs.collect()) == [0, 1]


def test_repeated_and_missing_ids(spark):
    make = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    text = lambda k: " ".join(f"{k}word{i}" for i in range(60))
    rows = [(1, text("a")), (1, text("b")), (1, text("b")), (2, text("b") + " more"), (3, text("a") + " more"), (3, text("c")), (4, text("d")), (None, text("a"))]
    gone = [(1, text("b")), (2, text("b") + " more"), (3, text("a") + " more")]
    expected = sorted([r for k, r in enumerate(rows) if r not in gone or k == 1], key=str)
    assert found(corpus_pipeline.near_duplicates(spark, make(rows), SF)) == expected
    unique = [(1, text("a")), (1, text("a")), (2, text("a") + " more"), (None, text("a"))]
    assert found(corpus_pipeline.near_duplicates(spark, make(unique), SF)) == sorted([unique[0], unique[3]], key=str)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null").orderBy("item_id").first()["text"]
    rows = [(None, "Before. " + item), (None, text("a")), (5, text("b")), (5, item), (6, text("c"))]
    assert found(corpus_pipeline.decontamination(spark, make(rows), SF)) == sorted([rows[1], rows[2], rows[4]], key=str)
