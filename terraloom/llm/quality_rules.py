"""Quality rules by distribution divergence, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ASCII_SPACE, written

SYMBOLS = "#*$%&|<>"
#: Each class is what is left of a text without the runs that the pattern names.
CLASSES = {"upper": "[^A-Z]+", "digit": "[^0-9]+", "mark": "[^.,;:!?'\"()-]+", "symbol": f"[^{SYMBOLS}]+", "wide": r"[\x00-\x7F]+"}
#: Windows of so many words that are found again count as repeated.
WINDOW = 8
#: Common words are looked up in one of so many short lists.
SLOTS = 128


def settled(df: DataFrame) -> DataFrame:
    """The same rows, each computed once.

    Projections that follow one another are merged, and a column read in many places is then
    computed in each of them. What a generator makes isn't merged into what reads it.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def let(value: Column, made: Callable[[Column], Column]) -> Column:
    """``made`` of a value that is computed once, however often it is read there."""
    return F.get(F.transform(F.array(value), made), F.lit(0))


def _spaced(docs: DataFrame, id_col: str, text_col: str, lang_col: str | None) -> DataFrame:
    """doc_id, lang, text (null: empty) and spaced, the text with a space for each white space."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")) if lang_col else F.lit("und")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), lang.alias("lang"), text.alias("text"))
    return base.withColumn("spaced", F.regexp_replace("text", f"[{ASCII_SPACE.strip(' ')}]", " "))


def common_words(docs: DataFrame, common: int, id_col: str, text_col: str, lang_col: str | None) -> DataFrame:
    """Per language: hashes of its most frequent words in lower case (ties by name), their counts ``found``, and the hashes by their lowest bits."""
    words = F.explode(F.split(F.lower("spaced"), " "))
    counted = _spaced(docs, id_col, text_col, lang_col).select("lang", words.alias("w")).filter("w <> ''").groupBy("lang", "w").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w"))
    top = counted.withColumn("r", rank).filter(F.col("r") <= common)
    top = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("r", "w", "n"))).alias("top"))
    top = top.select("lang", F.transform("top", lambda t: F.xxhash64(t["w"])).alias("hashes"), F.transform("top", lambda t: t["n"]).alias("found"))
    return top.withColumn("slots", F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda k: F.filter("hashes", lambda h: h.bitwiseAND(F.lit(SLOTS - 1)) == k)))


def _js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence in bits, rounded to six places."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / F.greatest(a + b, F.lit(1e-300)))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    return F.round(F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2)), 6)


def _paired(hashes: Column, step: int) -> Column:
    """Hashes of twice as many words as those of ``step`` words each."""

    def zipped(h: Column) -> Column:
        left = F.greatest(F.lit(0), F.size(h) - step)
        return F.zip_with(F.slice(h, F.lit(1), left), F.slice(h, F.lit(1 + step), left), lambda a, b: F.xxhash64(a, b))

    return let(hashes, zipped)


def _again(hashes: Column) -> Column:
    return F.size(F.array_distinct(hashes)) < F.size(hashes)


def _repeated(windows: Column) -> Column:
    """Words in windows whose hash is found twice or more."""

    def starts(placed: Column) -> Column:
        last = F.size(placed)
        before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(placed, F.lit(1), last - 1))
        paired = F.zip_with(placed, before, lambda x, p: F.struct(x["h"].alias("h"), x["i"].alias("i"), p["h"].alias("p")))
        found = F.zip_with(paired, F.slice(placed, F.lit(2), last), lambda x, n: F.when((x["h"] == x["p"]) | (x["h"] == n["h"]), x["i"]))
        return F.sort_array(F.array_compact(found))

    def covered(at: Column) -> Column:
        step = F.zip_with(at, F.slice(at, F.lit(2), F.size(at)), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(step, F.lit(0).cast("long"), lambda s, x: s + x)

    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(placed, starts), covered)


def _measured(docs: DataFrame, words_of: DataFrame, small: bool, id_col: str, text_col: str, lang_col: str | None) -> DataFrame:
    """A row per document without its text: the base's counts, characters by class, and counts of its language's common words.

    Words are told apart by 64-bit hashes.
    """
    m = settled(_spaced(docs, id_col, text_col, lang_col).withColumn("signs", F.regexp_replace("text", f"[a-z{ASCII_SPACE}]+", "")))
    m = m.join(F.broadcast(words_of) if small else words_of, "lang", "left")
    words = F.array_remove(F.split("spaced", " "), "")
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _paired(_paired(F.transform(w, lambda x: F.xxhash64(x)), 1), 2).alias("fours")))
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(ASCII_SPACE)) != "")
    seen = F.filter(F.transform(F.split(F.lower("spaced"), " "), lambda w: F.xxhash64(w)), lambda h: F.exists(F.get("slots", h.bitwiseAND(F.lit(SLOTS - 1))), lambda x: x == h))
    m = settled(m.select(
        "doc_id", "lang", F.length("text").cast("long").alias("chars"), F.length(F.replace("spaced", F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"), of_words.alias("words"), seen.alias("seen"), "hashes", "found",
        F.array(*(F.length(F.regexp_replace("signs", p, "")).cast("long") for p in CLASSES.values())).alias("named"),
    ))
    # no window of eight words is found again where none of four is
    windows = F.when(_again(F.col("words.fours")), _paired(F.col("words.fours"), WINDOW // 2))
    repeats = let(windows, lambda w: F.when(_again(w), _repeated(w)))
    counts = F.transform("hashes", lambda h: (F.size("seen") - F.size(F.array_remove("seen", h))).cast("long"))
    gaps = F.col("chars") - F.col("word_chars")
    classes = F.concat("named", F.array(gaps, F.col("chars") - gaps - F.aggregate("named", F.lit(0).cast("long"), lambda a, x: a + x)))
    return m.select("doc_id", "lang", F.col("words.n").alias("n_words"), "word_chars", F.col("named")[list(CLASSES).index("symbol")].alias("n_symbols"), "n_dup_lines", F.coalesce(repeats, F.lit(0)).cast("long").alias("n_repeat_words"), classes.alias("classes"), "found", counts.alias("counts"))


def quality_rules(
    docs: DataFrame,
    max_char_distance: float = 0.14,
    char_slack: float = 1.2,
    max_word_distance: float = 0.15,
    word_slack: float = 1.8,
    min_words: int = 40,
    common: int = 24,
    min_ref_words: int = 1000,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
) -> DataFrame:
    """Judges every whole text by its distance to its language, after plain rules.

    Character-class and common-word histograms of a text are held against those of all texts of
    its language (``lang_col``; null: the language 'und'; None: one language) by Jensen-Shannon
    distance. Common words are the ``common`` most frequent words of all texts of the language,
    in lower case. A text of n words may be as far as the maximum plus ``slack / sqrt(n)``, since
    histograms of short texts scatter. Texts of fewer than ``min_words`` words, and languages
    with fewer than ``min_ref_words`` words, have no distance (null) and pass.

    Texts are read twice: to count words by language, and to measure each text; the measures,
    some 200 bytes a row, are written to the shared folder, and class references come from them.

    One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, char_distance, word_distance. Null or empty text: no
    words, so base_failed. Null ids and repeated rows: a row each. Other columns: ignored.
    No rows: no rows. References are one row per language; they are broadcast only while they
    have no more than 1,000 rows.
    """
    words_of = written(common_words(docs, common, id_col, text_col, lang_col), "common-words")
    small = words_of.limit(1001).count() <= 1000
    m = written(_measured(docs, words_of, small, id_col, text_col, lang_col), "measures")
    cells = len(CLASSES) + 2
    sums = m.groupBy("lang").agg(*(F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(cells)), F.sum("n_words").alias("all_words")).filter(F.col("all_words") >= min_ref_words)
    total = F.greatest(F.lit(1), sum((F.col(f"c{i}") for i in range(1, cells)), F.col("c0")))
    refs = sums.select("lang", "all_words", F.array(*(F.col(f"c{i}") / total for i in range(cells))).alias("char_ref"))
    m = m.join(F.broadcast(refs) if small else refs, "lang", "left")
    judged = F.col("char_ref").isNotNull() & F.col("found").isNotNull() & (F.col("n_words") >= min_words)
    some = F.greatest("n_words", F.lit(1))  # never a division by zero, whatever is evaluated early

    def of_all(counts: Column, all_: Column) -> Column:
        """Shares of the counts, and of what is none of them."""
        whole = F.transform(counts, lambda n: n / all_)
        return F.concat(whole, F.array((all_ - F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)) / all_))

    text_total = F.greatest(F.lit(1), F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x))
    m = settled(m.withColumns({
        "char_distance": F.when(judged, let(text_total, lambda t: _js_distance(F.transform("classes", lambda n: n / t), F.col("char_ref")))),
        "word_distance": F.when(judged, _js_distance(of_all(F.col("counts"), some), of_all(F.col("found"), F.col("all_words")))),
    }).drop("classes", "counts", "found", "char_ref", "all_words"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    room = 1 / F.sqrt(F.greatest("n_words", F.lit(1)))
    far = (F.col("char_distance") > F.round(max_char_distance + char_slack * room, 6)) | (F.col("word_distance") > F.round(max_word_distance + word_slack * room, 6))
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~F.coalesce(far, F.lit(False))).alias("kept"), "char_distance", "word_distance")
