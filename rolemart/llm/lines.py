"""Line-first cleaning with DataFrame functions only.

Each line is judged on its own: by its punctuation, by what marks it as navigation, and as boilerplate. Lines that fail are
removed; a document is rejected if it fails the base rules or if the removed lines held too much of its text. Everything
is computed within the row of the document, so there is no shuffle and no group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemart.llm.common import spare, text_of

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOL = r"[#*$%&|<>]"
#: How a sentence, a heading with a colon, a quotation or a bracket ends.
_ENDS = r"[.!?…:;\"'”’»)\]。！？][\x20\x09-\x0D]*$"
_NAVIGATION = r"\|[^|]*\||[»›→].*[»›→]|^[\x20\x09]*(?i:home|menu|login|log in|sign in|sign up|search|next|previous|back to top|read more|skip to content)[\x20\x09]*$"
_BOILERPLATE = (
    r"(?i)all rights reserved|terms of (?:use|service)|privacy policy|cookie (?:policy|settings)|use of cookies|click here|"
    r"subscribe to|share (?:this|on)|lorem ipsum|enable javascript|licensed under|copyright (?:©|\(c\)|[0-9]{4})"
)


def _count(text: Column, pattern: str) -> Column:
    """Characters of a one-character class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _solid(text: Column) -> Column:
    return F.length(F.regexp_replace(text, _SPACE, ""))


def failed_rule(line: Column) -> Column:
    """The first rule that the line fails, NULL if none: punctuation, navigation or boilerplate."""
    size = F.length(line)
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(line, r"[^\p{Lu}]+", ""))
    unended = ~line.rlike(_ENDS)
    words = F.size(F.split(F.trim(line), _SPACE))
    return (
        F.when(line.rlike(_NAVIGATION) | (unended & (words <= 2)), "navigation")
        .when(line.rlike(_BOILERPLATE), "boilerplate")
        .when((_count(line, _SYMBOL) * 20 > size) | line.rlike(r"!!+.*!!+.*!!+") | ((letters >= 20) & (capitals * 2 > letters))
              | (unended & (words >= 200)), "punctuation")
    )


def with_line_verdict(docs: DataFrame, column: str, max_lost: float = 0.5, min_words: int = 10, max_repeat: float = 0.2) -> DataFrame:
    """All rows and columns of ``docs`` and, as ``column``, what the rules find in the whole of ``text``.

    The struct has n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed (number of removed lines
    by rule), clean_text (the lines that stay, in order), lost (the removed share of the word characters) and kept.

    Base rules: at least ``min_words`` words, and at most ``max_repeat`` of them in five-word windows that occur twice. A
    document is kept if it meets these and lost at most ``max_lost``. NULL and empty texts have no words and are not kept.
    Lines without a word are neither removed nor counted. Repeated rows get equal results, an empty table stays empty, and
    further columns pass through.
    """
    words, lines, grams, order, at, out = (spare(docs, f"line_{n}") for n in ("words", "lines", "grams", "order", "at", "text"))
    text = F.col(out)
    split = docs.withColumn(out, text_of(docs)).withColumns({
        words: F.filter(F.split(text, _SPACE), lambda w: w != ""),
        lines: F.transform(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(_WORD)),
                           lambda x: F.struct(x.alias("line"), failed_rule(x).alias("rule"))),
    })
    n = F.size(words)
    window = F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*(F.get(F.col(words), i + k) for k in range(5))))
    hashed = split.withColumn(grams, F.when(n >= 5, window).otherwise(F.array().cast("array<bigint>")))
    # only texts with a repeated window sort their windows; most have none
    repeated = F.size(F.array_distinct(grams)) < F.size(grams)
    sorted_ = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = hashed.withColumn(order, F.when(repeated, sorted_))

    def twice(s: Column, k: Column) -> Column:
        same = [F.coalesce(F.get(F.col(order), k + d)["h"] == s["h"], F.lit(False)) for d in (-1, 1)]
        return same[0] | same[1]

    placed = ordered.withColumn(at, F.array_sort(F.transform(F.filter(order, twice), lambda s: s["i"])))
    covered = F.aggregate(
        F.transform(at, lambda i, k: F.least(F.lit(5), F.coalesce(F.get(F.col(at), k + 1) - i, F.lit(5)))), F.lit(0), lambda a, x: a + x)
    n_repeat = F.coalesce(covered, F.lit(0)).cast("long")

    def line_chars(keep) -> Column:
        return _solid(F.array_join(F.transform(F.filter(lines, keep), lambda x: x["line"]), ""))

    def removed_by(rule: str) -> Column:
        return F.size(F.filter(lines, lambda x: x["rule"] == rule)).alias(rule)

    stay = F.filter(lines, lambda x: x["rule"].isNull())
    counted = F.struct(*map(removed_by, ("punctuation", "navigation", "boilerplate")))
    chars = F.length(F.array_join(words, "")).cast("long")
    lost = F.when(chars > 0, line_chars(lambda x: x["rule"].isNotNull()) / chars).otherwise(0.0)
    all_lines = F.transform(lines, lambda x: x["line"])
    result = F.struct(
        n.cast("long").alias("n_words"), chars.alias("word_chars"), _count(text, _SYMBOL).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(all_lines))).cast("long").alias("n_dup_lines"), n_repeat.alias("n_repeat_words"),
        counted.alias("removed"), F.array_join(F.transform(stay, lambda x: x["line"]), "\n").alias("clean_text"), lost.alias("lost"),
    )
    failed = (F.col(f"{column}.n_words") < min_words) | (F.col(f"{column}.n_repeat_words") > max_repeat * F.col(f"{column}.n_words"))
    return (
        placed.withColumn(column, result)
        .withColumn(column, F.col(column).withField("base_failed", failed))
        .withColumn(column, F.col(column).withField("kept", ~F.col(f"{column}.base_failed") & (F.col(f"{column}.lost") <= max_lost)))
        .drop(words, lines, grams, order, at, out)
    )
