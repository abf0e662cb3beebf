"""Quality rules: rules on the words of a text, and cross-document line frequency.

Lines are normalised and hashed; a line in `least` different texts of a host is boilerplate
there, however large the host is; judge counts its words, cleaned takes it out of the text,
drop_poor leaves the texts as they were. A document is rejected if the rules on its own words
fail, or if it is depleted: too few of its words are left without the boilerplate. Exact
copies are one text, so they never make their own lines boilerplate.

Counts combine before the shuffle, one row per document and different line. A line in few
rows is in few texts, so texts are only told apart for lines in `least` rows or more. A line
common enough to be hot is what the search is for; its rows are joined to the short list
of common lines, and adaptive execution broadcasts that list or splits the hot key.

Defined results: a null or empty text has no words and fails; a null host is a host of
its own; repeated rows are judged alike; a text of any length is read whole, in one task; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import BLANK_CHARS, BLANKS, carried, keep_rows, let, same, text_of
from tallyloom.sources.stage import stage

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
# A common line is in this many different texts of its host.
LINE_TEXTS = 50
# A document is depleted if less than this share of its words is left, or fewer than MIN_WORDS.
WORDS_LEFT = 0.3


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANK_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))


def without(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def repeated_words(words: Column) -> Column:
    """Number of words inside windows of WINDOW words that occur twice or more in the text.

    Windows are compared by hash. Most texts repeat none, which a count of different
    hashes shows; only the others sort their windows.
    """

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twice = F.filter(
                s,
                lambda e, k: (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"]),
            )
            return F.array_sort(F.transform(twice, lambda e: e["i"]))

        def union(p: Column) -> Column:
            steps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(let(placed, starts), union)

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW + 1, 0).otherwise(let(let(hashed, windows), counted))


def line_hashes(text: Column) -> Column:
    """Place, hash and size of the normalised lines with a word in them: lower case, single spaces."""
    plain = F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " ")
    lines = F.transform(F.split(plain, "\n"), lambda x, i: F.struct(F.trim(x).alias("x"), i.alias("pos")))
    return F.transform(
        F.filter(lines, lambda e: e["x"] != ""),
        lambda e: F.struct(e["pos"].alias("pos"), F.xxhash64(e["x"]).alias("line"), F.size(F.split(e["x"], " ")).alias("words")),
    )


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines at the places `gone`, which are in order; a text without any stays as it is."""

    def stretch(lines: Column, i: Column) -> Column:
        before = F.when(i == 0, -1).otherwise(F.get(gone, i - 1))
        return F.slice(lines, before + 2, F.coalesce(F.get(gone, i), F.size(lines)) - before - 1)

    places = F.sequence(F.lit(0), F.size(gone))
    left = let(F.split(text, "\n"), lambda lines: F.flatten(F.transform(places, lambda i: stretch(lines, i))))
    return F.when(F.size(gone) > 0, F.array_join(left, "\n")).otherwise(text)


def own_rules(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Figures of each text by itself, and whether they fail."""
    texts = text_of(docs, id_col, text_col)
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANK_CHARS)) != "")
    seen = texts.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        words_of(F.col("text")).alias("words"),
        (F.char_length("text") - without(F.col("text"), BLANK_CHARS)).cast("long").alias("word_chars"),
        without(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    figures = seen.select(
        "doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )
    too_short = F.col("n_words") < MIN_WORDS
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    return figures.withColumn("base_failed", too_short | repeats)


def common_line_words(
    docs: DataFrame, id_col: str, text_col: str, host_col: str, least: int
) -> DataFrame:
    """(doc_id, text_hash, common_words, common_lines): words in lines that are common in the host, and their places in order.

    The host is that of the row; rows that repeat an id and a text in several hosts lose the lines common in any of them.
    """
    texts = text_of(docs, id_col, text_col, host_col).withColumnRenamed(host_col, "host") if host_col != "host" else text_of(docs, id_col, text_col, "host")
    rows = texts.select(
        "doc_id", "host", F.xxhash64("text").alias("text_hash"), line_hashes(F.col("text")).alias("lines")
    )
    lines = stage(
        rows.select(
            "doc_id", "host", "text_hash",
            F.explode_outer("lines").alias("at"),
        ).select("doc_id", "host", "text_hash", "at.pos", "at.line", "at.words")
    )

    def among(table: DataFrame, listed: DataFrame) -> DataFrame:
        named = listed.select(F.col("host").alias("_host"), F.col("line").alias("_line"))
        return table.join(named, same(table, named, [("host", "_host"), ("line", "_line")]), "left_semi")

    # a document counts once for a line, however often it repeats it
    in_docs = rows.select("host", F.explode(F.array_distinct("lines.line")).alias("line"))
    counts = in_docs.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    lines_in_many = stage(among(lines, counts))
    in_texts = lines_in_many.select("host", "line", "text_hash").distinct()
    common = in_texts.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    hit = among(lines_in_many, common)
    # repeated rows name the same lines; they are judged once
    once = hit.select("doc_id", "text_hash", "pos", "words").distinct()
    return once.groupBy("doc_id", "text_hash").agg(
        F.sum("words").alias("common_words"), F.sort_array(F.collect_list("pos")).alias("common_lines")
    )


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str, least: int) -> DataFrame:
    own = own_rules(docs, id_col, text_col)
    shared = common_line_words(docs, id_col, text_col, host_col, least).withColumnsRenamed(
        {"doc_id": "_id", "text_hash": "_hash"}
    )
    both = own.join(shared, same(own, shared, [("doc_id", "_id"), ("text_hash", "_hash")]), "left").drop("_id", "_hash")
    both = both.withColumn("common_words", F.coalesce("common_words", F.lit(0)).cast("long"))
    left = F.col("n_words") - F.col("common_words")
    depleted = (left < MIN_WORDS) | (left < WORDS_LEFT * F.col("n_words"))
    return both.withColumn("kept", ~F.col("base_failed") & ~depleted)


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    least: int = LINE_TEXTS,
) -> DataFrame:
    """One row per row of docs: the figures, base_failed, common_words and kept."""
    return _judged(docs, id_col, text_col, host_col, least).drop("common_lines")


def drop_poor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """The documents that pass, all columns as they were."""
    return keep_rows(docs, judge(docs, id_col, text_col, host_col, **limits).where("kept"), id_col, text_col)


def cleaned(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    least: int = LINE_TEXTS,
) -> DataFrame:
    """The documents that pass, their texts without the common lines; all other columns as they were."""
    passed = _judged(docs, id_col, text_col, host_col, least).where("kept")
    # repeated rows have the same lines
    named = passed.groupBy(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).agg(
        F.first("common_lines").alias("gone")
    )
    rows = carried(docs, text_col, doc_id=id_col, text=text_col)
    joined = rows.join(named, same(rows, named, [("doc_id", "kept_id"), ("text_hash", "kept_hash")]))
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    texts = joined.select(F.col("row").withField(f"`{text_col}`", without_lines(F.col("text"), gone)).alias("row"))
    return texts.select("row.*")
