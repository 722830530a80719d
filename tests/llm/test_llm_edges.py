"""Clashing column names, texts that fool weak hashes, very long texts, and what else the operators promise for odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from curata.llm import anchors, bpe, common, jaccard, line_dedup, quality, sharding, substring_dedup, suffix_dedup
from curata.llm.op9_bpe import default_vocabulary


def thue_morse(n, a, b):
    return "".join(b if bin(k).count("1") % 2 else a for k in range(n))


@pytest.mark.parametrize("seed", [0, 7])
def test_span_hashes(seed):
    texts = [b"", b"a", b"a\0", b"abcdefgh", b"abcdefgh\0", b"x" * 127, b"x" * 128, b"x" * 129, b"x" * 5000, *(thue_morse(n, *ab).encode() for n in (64, 128, 1024, 8192) for ab in ("ab", "ba"))]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    once = common.span_hashes(data, starts, ends, seed)
    assert len(set(once.tolist())) == len(texts)
    for k, t in enumerate(texts):  # a span's hash doesn't depend on where it lies
        moved = np.frombuffer(b"zz" + t + b"q", np.uint8)
        assert common.span_hashes(moved, np.array([2]), np.array([2 + len(t)]), seed)[0] == once[k]


def test_sequence_hashes():
    values = np.array([3, 5, 8, 3, 5, 8, 3, 5], np.uint64)
    h = common.sequence_hashes(values, np.array([0, 3, 0, 3, 6]), np.array([3, 3, 2, 2, 2]))
    assert h[0] == h[1] and h[2] == h[3] == h[4] and h[0] != h[2]


def test_names_that_clash(spark):
    text = "Plain words make up this line of the text, and it ends here.\n" * 6
    docs = spark.createDataFrame([(1, text, "x"), (2, None, "y")], "doc_id bigint, text string, `a.b` string")
    names = ["_lines", "KEPT", "hashes", "_key", "_keep", "key", "N_LINES", "_h", "h", "SHARD", "prefix", "at", "Token_Ids"]
    odd = docs.select("*", *(docs["doc_id"].alias(n) for n in names))
    for found, result in ((quality.judged(odd), "kept"), (line_dedup.drop_lines(odd), "n_lines"), (sharding.assign(odd, 100), "shard"), (bpe.encode(odd, default_vocabulary()), "token_ids")):
        rows = found.collect()
        assert len(rows) == 2 and len({c.lower() for c in found.columns}) == len(found.columns) and result in found.columns
        for name in names:
            if name in found.columns:
                assert {r["doc_id"]: r[name] for r in rows} == {1: 1, 2: 2}
        assert {"_lines", "hashes", "_key", "_keep", "key", "_h", "h", "prefix", "at", "a.b"} <= set(found.columns)


def test_boilerplate_needs_whole_words_and_short_lines(spark):
    prose = {
        "The museum keeps its catalog in the basement, where few people go.": False, "The studio improved the design in the second year.": False, "They assign up to nine of them.": False, "A dialog in the play is long.": False,
        "Sign in to read on.": True, "All rights reserved.": True, "Tous droits réservés.": True, "Alle Rechte vorbehalten.": True, "TODOS LOS DERECHOS RESERVADOS.": True, "Política de privacidad.": True,
        "We had a cookie with tea that afternoon, and then another one, and after that we went out for a walk.": False, "Ein ganzer Satz, der hier endet, sagt etwas aus und schließt mit einem Wort.“": False,
    }
    df = spark.createDataFrame([(k, t) for k, t in enumerate(prose)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_failed_lines"] for r in quality.judged(df).collect()}
    assert {t: bool(got[k]) for k, t in enumerate(prose)} == prose


def test_lines_that_fool_weak_hashes(spark):
    a, b = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    rows = [(k, f"{a if k % 2 else b}\nown {k}") for k in range(12)]
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), 10).collect()}
    assert set(got.values()) == {0}
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), 6).collect()}
    assert set(got.values()) == {1}


def test_long_texts(spark):
    lines = "\n".join(f"this is line {k} of a text that goes on." for k in range(60_000))
    df = spark.createDataFrame([(1, lines), (2, lines[:1_000_000]), (3, "z" * 3_000_000)], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in line_dedup.drop_lines(df, 2).collect()}
    shared = lines[:1_000_000].split("\n")
    found = set(shared[:-1])
    left = [x for x in lines.split("\n") if x not in found]
    assert got[1] == (60_000, 60_000 - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest())
    assert got[2][0] == len(shared) and got[2][1] >= len(shared) - 1 and got[3][:2] == (1, 0)
    judged = {r["doc_id"]: r["n_words"] for r in quality.judged(df).select("doc_id", "n_words").collect()}
    assert judged == {1: 600_000, 2: len(lines[:1_000_000].split()), 3: 1}


def test_shards_are_written_in_few_folders(spark, tmp_path):
    df = spark.createDataFrame([(k, "x" * 50) for k in range(400)], "doc_id bigint, text string")
    dealt = sharding.assign(df, 200)
    sharding.write(dealt, str(tmp_path / "shards"), folder_bits=3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 400 and len([p for p in (tmp_path / "shards").iterdir() if p.is_dir()]) <= 8
    assert back.select("doc_id", "shard").exceptAll(dealt.select("doc_id", "shard")).isEmpty()


def test_shared_folder_is_asked_for_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(Session())


def removed_of(found):
    return {r["doc_id"]: r["n_removed"] for r in found.collect()}


def test_dedup_of_texts_that_fool_weak_hashes(spark, monkeypatch):
    monkeypatch.setattr(anchors, "HOT_RUNS", 2)
    rows, n = [], 0
    for size in (1024, 8192):
        for a, b in ("ab", "ba"):
            rows.append((n, thue_morse(size, a, b)))
            rows.append((n + 1, thue_morse(size // 2, a + " ", b + " ")))
            n += 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    starts, count = {}, {}
    for i, t in rows:
        for k in range(len(t) - 199):
            count[t[k : k + 200]] = count.get(t[k : k + 200], 0) + 1
        w = t.split()
        for k in range(len(w) - 12):
            starts.setdefault(tuple(w[k : k + 13]), i)
    expected, words = {}, {}
    for i, t in rows:
        w = t.split()
        expected[i] = len({k + j for k in range(len(t) - 199) if count[t[k : k + 200]] > 1 for j in range(200)})
        words[i] = len({k + j for k in range(len(w) - 12) if starts[tuple(w[k : k + 13])] < i for j in range(13)})
    assert removed_of(suffix_dedup.removed(df)) == expected
    assert removed_of(substring_dedup.removed(df)) == words
    pair = spark.createDataFrame([(1, " ".join(thue_morse(1024, "a", "b"))), (2, " ".join(thue_morse(1024, "b", "a"))), (3, thue_morse(1024, "a", "b")), (4, thue_morse(1024, "b", "a"))], "doc_id bigint, text string")
    classes = {r["doc_id"]: r["component_id"] for r in jaccard.classes(pair, 85, 1).collect()}
    assert classes == {1: 1, 2: 1, 3: 3, 4: 4}  # the first two have the same two words


@pytest.mark.parametrize("bits", [5, 24])
def test_anchors_don_t_depend_on_the_place(monkeypatch, bits):
    monkeypatch.setattr(anchors, "_PLACE_BITS", bits)
    monkeypatch.setattr(anchors, "_LOW", np.uint64((1 << bits) - 1))
    rng = random.Random(bits)
    grams = np.array([rng.choice([7, 9, 11]) << 30 for _ in range(400)], np.uint64)
    for width in (1, 4, 13):
        found = anchors.least_places(grams, width)
        assert found.tolist() == [min(range(k, k + width), key=lambda j: (int(grams[j]), j)) for k in range(400 - width + 1)]


def test_dedup_of_very_long_texts(spark):
    rng = np.random.default_rng(17)
    words = np.array([f"w{k}" for k in range(5000)])
    long = " ".join(words[rng.integers(0, 5000, 3_100_000)].tolist())  # 18 MB
    place = (1 << 24) - 5000  # a passage across byte 2 ** 24, and one near the end
    passage, tail = long[place : place + 10_000], long[-6000:]
    rows = [(1, long), (2, "#" + passage + "#"), (3, "#" + tail), (4, "nothing shared here at all")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert removed_of(suffix_dedup.removed(df)) == {1: 16_000, 2: 10_000, 3: 6000, 4: 0}
    got = removed_of(substring_dedup.removed(df))
    assert got[1] == got[4] == 0
    for k, part in ((2, passage), (3, tail)):
        assert len(part.split()) - 2 <= got[k] <= len(part.split())  # but for words that the cut halved


def test_many_rows_without_id(spark):
    rng = random.Random(18)
    line = " ".join(rng.choice("abcdefgh") * rng.randint(1, 5) for _ in range(120))
    rows = [(None, line + f" own {k} " + " ".join(str(rng.random()) for _ in range(30))) for k in range(300)]
    got = suffix_dedup.removed(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == 300 and all(r["doc_id"] is None and len(line) <= r["n_removed"] <= len(line) + 10 for r in got)


@pytest.mark.parametrize("by_doc", [False, True])
def test_repeated_keys(spark, monkeypatch, by_doc):
    """Hashes that are spread over partitions and those that aren't give the same rows."""
    rng = random.Random(20)
    rows = [(h, d, d * 10 + k) for h in range(40) for d in range(rng.choice([1, 1, 2, 30])) for k in range(rng.choice([1, 2, 3]))]
    keys = spark.createDataFrame(rows, "h bigint, doc bigint, key bigint").repartition(5)
    docs = {h: {d for g, d, _ in rows if g == h} for h, _, _ in rows}
    count = {h: sum(g == h for g, _, _ in rows) for h, _, _ in rows}
    expected = sorted(r for r in rows if (len(docs[r[0]]) if by_doc else count[r[0]]) > 1)
    for hot in ([], list(range(0, 40, 2)), list(range(40))):
        monkeypatch.setattr(anchors, "frequent", lambda sample, hot=hot: hot)
        assert sorted(map(tuple, anchors.repeated_keys(keys, keys, by_doc, "test").collect())) == expected


def test_large_ids_beside_missing_ones(spark):
    """A row without an id must not turn its neighbours' ids into floats; above 2**53 those fall together."""
    import corpus_pipeline

    base = 2**60
    rows = [(base + k, f"shared line\nown {k}") for k in range(10)] + [(None, "another line"), (base + 10, "another line")]
    plain = {(i, t): sum(x == "shared line" for x in t.split("\n")) for i, t in rows}
    for partitions in (1, 3):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(partitions)
        assert {(r["doc_id"], r["text"] if not r["n_dropped"] else "shared line\n" + r["text"]): r["n_dropped"] for r in line_dedup.drop_lines(df, 10).collect()} == plain
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_deduplication(spark, docs, "").collect()}
    assert got == {i: (t if i in (None, base, base + 10) else t.split("\n")[1]) for i, t in rows}


@pytest.mark.parametrize("held", [1, 7, 1 << 18])
def test_lines_held_back(spark, monkeypatch, held):
    """Very many equal lines of few documents leave the task early and are settled like the edges."""
    monkeypatch.setattr(line_dedup, "HELD_LINES", held)
    rows = [(k % 3 or None, "\n".join(["many"] * 400 + [f"own {k}"])) for k in range(6)] + [(k, "many\nfew") for k in range(10, 14)] + [(2**59 + k, "few\nmany") for k in range(3)]
    for least in (6, 7, 8, 10, 11):
        got = Counter((r["doc_id"], r["n_dropped"]) for r in line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), least).collect())
        docs = {w: len({i for i, t in rows if w in t.split("\n")}) for w in ("many", "few")}
        assert got == Counter((i, sum(docs.get(x, 0) >= least for x in t.split("\n"))) for i, t in rows)


def test_long_words(spark):
    """Words beyond the trie's length, against the library; memory stays near the word's own size."""
    import tracemalloc

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_vocabulary())
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé한") for _ in range(n)) for n in (1023, 1024, 1025, 5000, 60_000)]
    texts = [" ".join(words), words[4] + " " + words[4] + "\n" + words[2], "x" * 50_000, " " * 3000 + "=" * 3000]
    coder = bpe.Bpe.load(default_vocabulary())
    for t, ids in zip(texts, coder.encode_batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
        assert coder.decode(ids) == t
    assert not any(isinstance(w, str) and len(w) > bpe.TRIE_LENGTH for w in coder.known)
    tracemalloc.start()
    coder.encode_long("abcde" * 100_000)
    assert tracemalloc.get_traced_memory()[1] < 12 * 500_000 + (1 << 22)
    tracemalloc.stop()
