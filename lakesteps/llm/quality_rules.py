"""Line-first cleaning: judge each line, drop the lines that fail, reject texts that lose too much.

Only DataFrame functions; nothing is exploded or shuffled, as all counts stay inside one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lakesteps.llm.common import BLANKS, free_name, text_or_empty

WORD_GAP = "[ \\t-\\r]+"
WINDOW = 8


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules; a line fails when any rule holds."""

    #: More than this share of the characters are symbols.
    symbol_share: float = 0.1
    #: Menu: this many separators, and at least one for every ``words_per_separator`` words.
    separators: int = 3
    words_per_separator: int = 4
    #: Shouting: so many capitals, and more than this share of the line's characters.
    shout_letters: int = 15
    shout_share: float = 0.4
    #: This many words without one punctuation mark.
    unpunctuated_words: int = 40
    #: At most so many words and no closing mark: a menu entry or a button.
    label_words: int = 2
    #: Boilerplate phrases count in lines of at most so many characters.
    boilerplate_chars: int = 250
    #: A text that loses more than this share of its characters is rejected.
    lost_share: float = 0.7


BOILERPLATE = (
    r"(?i)\b(all rights reserved|licen[sc]ed under|released under the|"
    r"this work is licen[sc]ed|terms (of|and) (use|service|conditions)|privacy policy|"
    r"cookie (policy|settings|preferences)|(accept|uses|use) cookies|"
    r"enable javascript|javascript (is|must be) (disabled|enabled)|"
    r"(subscribe|sign up) (to|for) (our|the) newsletter|click here to|"
    r"(log|sign) in to (continue|your account)|skip to (main )?content)\b"
)
SEPARATORS = "|\u00bb\u203a\u2022\u00b7"
SYMBOLS = "[^#*$%&|<>]+"


def line_fails(line: Column, rules: LineRules = LineRules()) -> Column:
    """True for a line that a punctuation, navigation or boilerplate rule removes.

    Blank lines never fail: they separate paragraphs.
    """
    count = lambda keep: F.length(F.regexp_replace(line, keep, ""))
    bare = F.btrim(line, F.lit(BLANKS))
    n_words = F.size(F.split(bare, WORD_GAP))
    separators = sum((F.length(line) - F.length(F.replace(line, F.lit(c), F.lit("")))
                      for c in SEPARATORS), F.lit(0))
    capitals = count("\\P{Lu}+")
    # In each pair the cheap test that clean lines fail comes first.
    return (
        line.rlike("[^ \\t-\\r]")
        & ((count(SYMBOLS) > rules.symbol_share * F.length(line))
           | ((separators >= rules.separators) & (separators * rules.words_per_separator >= n_words))
           | ((capitals >= rules.shout_letters) & (capitals > rules.shout_share * F.length(line)))
           | (~line.rlike("\\p{P}") & (n_words >= rules.unpunctuated_words))
           | (~F.right(bare, F.lit(1)).rlike("[.!?:;,\u2026\"'\u201d\u2019)]")
              & (n_words <= rules.label_words))
           | ((F.length(line) <= rules.boilerplate_chars) & line.rlike(BOILERPLATE)))
    )


def _repeated_windows(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add ``out``: words that lie in 8-word windows found twice or more in the same array.

    A window found twice holds 4-word windows found twice, so rows without those are done. In the
    others 8-word windows are compared by hash, and of rows with two equal hashes only the windows
    concerned are sorted by their words: equal hashes of unlike windows do no harm.
    """
    names = {k: free_name(df, f"__{out}_{k}") for k in
             ("word", "pair", "four", "hash", "order", "alike")}
    hashes, ordered, alike = names["hash"], names["order"], names["alike"]
    w = F.col(words)
    window = lambda i: F.slice(w, i, WINDOW)

    def doubled(name: str, step: int) -> Column:
        x = F.col(name)
        rest = F.slice(x, step + 1, F.greatest(F.lit(0), F.size(x) - step))
        return F.slice(F.zip_with(x, rest, lambda a, b: F.xxhash64(a, b)), F.lit(1), F.size(rest))

    df = df.withColumn(names["word"], F.when(
        F.size(w) > WINDOW, F.transform(w, lambda x: F.xxhash64(x))))
    df = df.withColumn(names["pair"], doubled(names["word"], 1))
    df = df.withColumn(names["four"], doubled(names["pair"], 2))
    four = F.col(names["four"])
    df = df.withColumn(hashes, F.when(
        F.size(F.array_distinct(four)) < F.size(four),
        F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(window(i)))))
    h = F.col(hashes)
    df = df.withColumn(ordered, F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("k"), (i + 1).alias("i"))))))

    def twins(column: Column) -> Column:
        return F.filter(column, lambda x, i: (
            ((i > 0) & (F.get(column, i - 1)["k"] == x["k"]))
            | (F.get(column, i + 1)["k"] == x["k"])))

    df = df.withColumn(alike, F.sort_array(F.transform(
        twins(F.col(ordered)), lambda x: F.struct(window(x["i"]).alias("k"), x["i"].alias("i")))))
    starts = F.sort_array(F.transform(twins(F.col(alike)), lambda x: x["i"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["n"] + s + WINDOW - F.greatest(a["end"], s)).alias("n"),
                              (s + WINDOW).alias("end")),
        lambda a: a["n"])
    return df.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop(*names.values())


def line_first_quality(docs: DataFrame, text: str = "text", rules: LineRules = LineRules(),
                       out: str = "quality") -> DataFrame:
    """``docs`` and a struct ``out`` with the measures, the cleaned text and the verdict.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept
    (boolean), clean_text: the lines that pass, with blank lines kept.

    A null or empty text has no words, so it fails and its clean_text is empty. Rows are judged
    one by one: repeated rows, and nulls in other columns, change nothing. An existing column
    ``out`` is replaced; others keep their names, whatever they are.
    """
    base = docs.drop(out)
    names = {k: free_name(base, f"__quality_{k}") for k in
             ("text", "words", "lines", "passed", "n_dup", "repeat", "n_words")}
    col = {k: F.col(v) for k, v in names.items()}
    df = base.withColumn(names["text"], text_or_empty(text))
    df = df.withColumns({
        names["words"]: F.array_remove(F.split(col["text"], WORD_GAP), ""),
        names["lines"]: F.split(col["text"], "\n"),
    })
    worded = F.filter(col["lines"], lambda x: x.rlike("[^ \\t-\\r]"))
    df = df.withColumns({
        names["n_words"]: F.size(col["words"]).cast("long"),
        names["passed"]: F.array_join(
            F.filter(col["lines"], lambda x: ~line_fails(x, rules)), "\n"),
        names["n_dup"]: worded,
    })
    df = df.withColumn(names["n_dup"],
                       (F.size(col["n_dup"]) - F.size(F.array_distinct(col["n_dup"]))).cast("long"))
    df = _repeated_windows(df, names["words"], names["repeat"])
    word_chars, failed = free_name(df, "__quality_chars"), free_name(df, "__quality_failed")
    df = df.withColumns({
        word_chars: F.length(F.array_join(col["words"], "")).cast("long"),
        failed: (col["n_words"] < 20) | (100 * col["repeat"] > 30 * col["n_words"]),
    })
    lost = F.length(col["passed"]) < (1 - rules.lost_share) * F.length(col["text"])
    quality = F.struct(
        col["n_words"].alias("n_words"), F.col(word_chars).alias("word_chars"),
        F.length(F.regexp_replace(col["text"], SYMBOLS, "")).cast("long").alias("n_symbols"),
        col["n_dup"].alias("n_dup_lines"), col["repeat"].alias("n_repeat_words"),
        F.col(failed).alias("base_failed"), (~F.col(failed) & ~lost).alias("kept"),
        col["passed"].alias("clean_text"))
    # A filter on the result would be pushed through all steps above, which copies each step into
    # every use of it; it stops at a generator.
    return df.select(*(F.col(f"`{c}`") for c in base.columns), F.explode(F.array(quality)).alias(out))


def keep_good(docs: DataFrame, text: str = "text", chars: str = "n_chars",
              rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, with failed lines gone and ``chars`` (if there is one) recounted.

    Columns and their order are those of ``docs``.
    """
    quality = free_name(docs, "__quality")
    judged = line_first_quality(docs, text, rules, quality).where(F.col(quality)["kept"])
    clean = F.col(quality)["clean_text"]
    new = {text: clean, chars: F.length(clean).cast("long")}
    return judged.select(*(
        new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"`{c}`")
        for c in docs.columns))
