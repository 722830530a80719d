"""Quality rules, native: each line is judged first, failing lines go, then documents that lose too much go.

Everything is a Spark SQL expression on one row, so the plan is one scan and projections: no shuffle, no Python.
Arrays that more than one expression needs are columns of a projection of their own; an array that a lambda reads
by position is bound once, as the variable of an outer lambda over a one-element array.

A line fails if it is
- noise: over one symbol of `[#*$%&|<>]` for ten characters,
- navigation: three or more `|`, or under ten words with no sentence end,
- shouting: three or more `!!`,
- boilerplate: under NOTICE_WORDS words, with a phrase of rights, licence, cookie, subscription and similar notices in
  English, German, French or Spanish; the phrase stands between characters that are neither letters nor digits. A
  longer line that mentions such a phrase is prose.
Blank lines neither fail nor count. A document is kept unless its base rules fail or over max_loss of its
characters are on failing lines.

A null text has no words and fails; so does a document of under 50 words. Rows are judged one by one: repeated
rows, ties and further columns change nothing, and an empty table gives an empty result. A text of any length is
judged whole, within the memory that its arrays of lines and word hashes take. Columns of docs that have the name of a
result, in any case of letters, are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curata.llm.common import fresh, others, quoted

#: Phrases of lines that are no prose, for a case-insensitive search.
PHRASES = (
    "all rights reserved|licensed under|released under|copyright|terms of (?:use|service)|privacy policy|cookies?"
    "|subscribe|click here|sign (?:up|in)|log ?in|read more|share this|lorem ipsum|powered by"
    "|alle rechte vorbehalten|datenschutz(?:erklärung)?|impressum|nutzungsbedingungen|hier klicken|jetzt anmelden|newsletter abonnieren|weiterlesen"
    "|tous droits réservés|mentions légales|politique de confidentialité|conditions d.utilisation|cliquez ici|se connecter|lire la suite"
    "|todos los derechos reservados|aviso legal|política de privacidad|términos de (?:uso|servicio)|haga clic aquí|iniciar sesión|leer más"
)
BOILERPLATE = rf"(?:^|[^\p{{L}}\p{{N}}])(?:{PHRASES})(?:[^\p{{L}}\p{{N}}]|$)"
#: A line of so many words or more is no notice.
NOTICE_WORDS = 16
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
#: A line's end that closes a sentence, quotes and brackets after it included.
SENTENCE_END = r"[.!?:;…。！？][\"'”“’‘»«›‹)\]]*[\x20\x09-\x0D]*$"


def _bound(value: Column, f) -> Column:
    """f(value), with the value worked out once."""
    return F.transform(F.array(value), f)[0]


def line_fails(line: Column) -> Column:
    """Whether a line that holds a word is noise, navigation, shouting or boilerplate."""
    size = F.length(line)
    symbols = size - F.length(F.translate(line, SYMBOLS, ""))
    bars = size - F.length(F.translate(line, "|", ""))
    shouts = size - F.length(F.replace(line, F.lit("!!"), F.lit("!")))
    words = F.size(F.split(F.trim(line, F.lit(SPACE)), WORD_GAP))
    notice = lambda n: (~F.rlike(line, F.lit(SENTENCE_END)) & (n < 10)) | F.rlike(line, F.lit(f"(?iu){BOILERPLATE}"))
    return (symbols * 10 > size) | (bars >= 3) | (shouts >= 3) | _bound(words, lambda n: (n < NOTICE_WORDS) & notice(n))


def has_word(line: Column) -> Column:
    return F.trim(line, F.lit(SPACE)) != ""


def repeated_words(hashes: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, given the hash of each window in order."""

    def positions(s: Column) -> Column:
        found = F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))
        # F.get gives null outside the array, and null is no match
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    step = lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last"))
    return F.aggregate(_bound(ordered, positions), start, step, lambda a: a["n"])


def judged(docs: DataFrame, text: str = "text", max_loss: float = 0.5, min_words: int = 50) -> DataFrame:
    """All columns of docs, plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_failed_lines (bigint),
    base_failed, kept (boolean) and clean_text: the text without failing lines."""
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines", "base_failed", "kept", "clean_text"]
    kept = others(docs.columns, results)
    names = [quoted(c) for c in kept]
    hashes, lines, grams, full_lines, failed, left, loses = fresh([*kept, *results], "hashes", "lines", "grams", "full", "failed", "left", "loses")
    source = F.coalesce(F.col(quoted(text)), F.lit(""))
    trimmed = F.trim(source, F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))
    df = docs.select(
        *names,
        F.transform(words, lambda w: F.xxhash64(w)).alias(hashes),
        F.split(source, "\n").alias(lines),
        F.length(F.translate(source, SPACE, "")).alias("word_chars"),
        (F.length(source) - F.length(F.translate(source, SYMBOLS, ""))).alias("n_symbols"),
    )
    w = F.col(hashes)
    n = F.size(w)
    windows = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
        F.zip_with(F.zip_with(F.slice(w, F.lit(1), n - 2), F.slice(w, F.lit(2), n - 2), lambda a, b: F.xxhash64(a, b)), F.slice(w, F.lit(3), n - 2), lambda a, b: F.xxhash64(a, b))
    )
    df = df.select(
        *names, "word_chars", "n_symbols", n.alias("n_words"), windows.alias(grams),
        F.transform(lines, lambda x: F.struct(x.alias("line"), F.when(has_word(x), line_fails(x)).alias("fails"))).alias(lines),
    )
    full = F.transform(F.filter(lines, lambda x: x["fails"].isNotNull()), lambda x: x["line"])
    df = df.select(
        *names, "word_chars", "n_symbols", "n_words", full.alias(full_lines),
        # most documents repeat no window: one pass over a hash set tells
        F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(repeated_words(F.col(grams))).alias("n_repeat_words"),
        F.filter(lines, lambda x: F.coalesce(x["fails"], F.lit(False))).alias(failed),
        F.transform(F.filter(lines, lambda x: ~F.coalesce(x["fails"], F.lit(False))), lambda x: x["line"]).alias(left),
    )
    lost = F.aggregate(failed, F.lit(0), lambda a, x: a + F.length(F.translate(x["line"], SPACE, "")))
    df = df.select(
        *names, F.col("n_words").cast("bigint"), F.col("word_chars").cast("bigint"), F.col("n_symbols").cast("bigint"),
        (F.size(full_lines) - F.size(F.array_distinct(full_lines))).cast("bigint").alias("n_dup_lines"),
        F.col("n_repeat_words").cast("bigint"), F.size(failed).cast("bigint").alias("n_failed_lines"),
        ((F.col("n_words") < min_words) | (100 * F.col("n_repeat_words").cast("bigint") > 50 * F.col("n_words").cast("bigint"))).alias("base_failed"),
        (lost > max_loss * F.col("word_chars")).alias(loses), F.array_join(left, "\n").alias("clean_text"),
    )
    return df.select(*names, *results[:7], (~F.col("base_failed") & ~F.col(loses)).alias("kept"), "clean_text")
