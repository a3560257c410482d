"""Quality rules by distribution divergence.

Each document has two histograms: character classes (lower-case and other
letters, capitals, digits, white space, signs) and the 4,096 most frequent
words of its language, of any length: the first 16 have a bin each, the others
share bins by rank (17 to 32, 33 to 64 and so on), and one bin has all further
words. The references are the same
histograms summed over all documents of the language. A document is rejected
where the Jensen-Shannon distance (base 2, 0 to 1) to a reference exceeds its
limit, provided it is long enough for its histogram to mean anything and the
reference rests on enough words; and it is rejected by the base rules of the
contract (too few words, too many of them in repeated eight-word windows).
The limit for words is a share of the distance that a document without any
common word has from the reference of the language, and a fixed distance at most.

Only DataFrame functions run; there is no Python in the plan. A document's
own counts are made in its row and written once, so nothing is shuffled by
document; only the partial counts of words by language are, and the
references, a row for each language, are joined. Texts are read twice: for
the common words, then for the counts.

Defined cases: a null text has no words. ``lang`` null is a language of its
own. Documents without a usable reference, or shorter than the guard, are
judged by the base rules alone. Repeated rows each give a row. An empty table
gives an empty result. Extra columns are not read, whatever their names.
Windows are compared by a 64-bit hash of their words, common words by 59 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgeline.llm.shared import SPACES, text_or_empty, words_of, write_shared

WINDOW = 8
COMMON_WORDS = 4096
#: most frequent words that have a bin of their own (a power of two)
OWN_BINS = 16
#: the bin of all words that are not common; five bits hold a bin
OTHERS = OWN_BINS + (COMMON_WORDS // OWN_BINS).bit_length() - 1
BIN_BITS = 5
#: a letter for each bin, the last one for all other words
BIN_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"[:OTHERS + 1]
#: lists that the hashes of a language's common words are dealt to
LISTS = 1024
PARTS = 32
MIN_WORDS = 50
MIN_REFERENCE_WORDS = 2000
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.45
#: of the distance of a document without common words
MAX_WORD_SHARE = 0.75
ROW = "__row"
CLASSES = ("letter", "capital", "digit", "space", "sign")


def _removed(text: Column, pattern: str) -> Column:
    """Number of characters that the pattern matches."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def text_counts(text: Column) -> dict[str, Column]:
    return {
        "n_chars": F.length(text).cast("long"),
        "n_symbols": _removed(text, r"[#*$%&|<>]+").cast("long"),
        "capital": _removed(text, r"\p{Lu}+").cast("long"),
        "digit": _removed(text, "[0-9]+").cast("long"),
        "sign": _removed(text, r"[^\p{L}0-9\x20\x09-\x0D]+").cast("long"),
    }


def word_counts(text: Column, words: Column, common: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.trim(line, F.lit(SPACES)) != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    by_hash = _let(hashes, lambda h: F.struct(
        repeated_words(h).alias("n_repeat_words"),
        # a letter for each word's bin; a text without one letter is shorter by the number of times that it occurs
        _let(F.array_join(F.transform(h, lambda x: word_bin(x, common)), ""), lambda own: F.transform(
            F.array(*[F.lit(c) for c in BIN_LETTERS]), lambda c: (F.length(own) - F.length(F.replace(own, c, F.lit("")))).cast("double"))).alias("words")))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_dup_lines": _let(lines, lambda own: (F.size(own) - F.size(F.array_distinct(own))).cast("long")),
        "by_hash": by_hash,
    }


def _list_of(h: Column) -> Column:
    return F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(LISTS - 1)).cast("int")


def word_bin(h: Column, common: Column) -> Column:
    """The letter of the bin of the word with hash ``h``; ``common`` as in ``common_words``."""
    found = F.filter(F.get(common, _list_of(h)), lambda x: F.shiftrightunsigned(x.bitwiseXOR(h), BIN_BITS) == 0)
    bin_ = F.coalesce(F.get(found, F.lit(0)).bitwiseAND(F.lit((1 << BIN_BITS) - 1)).cast("int"), F.lit(OTHERS))
    return F.get(F.array(*[F.lit(c) for c in BIN_LETTERS]), bin_)


def repeated_words(hashes: Column) -> Column:
    """Words covered by eight-word windows that occur twice or more, from the
    hashes of the words. A window that comes again brings five four-word
    windows that came before, so texts with fewer of them pay for no more."""
    def fours(h: Column) -> Column:
        return _let(_joined(h, 1), lambda pairs: _joined(pairs, 2))

    def again(f: Column) -> Column:
        few = F.size(f) - F.size(F.array_distinct(f)) < WINDOW // 2 + 1
        return F.when(few, F.lit(0).cast("long")).otherwise(_let(_joined(f, 4), _covered_words))

    return _let(fours(hashes), again)


def _covered_words(windows: Column) -> Column:
    """Sorting (hash, place) brings equal windows together; the places of
    those are sorted again, and each covers the words up to the next one, eight at most."""
    def places(pairs: Column) -> Column:
        n = F.size(pairs)
        again = F.filter(pairs, lambda p, i: (
            ((i > 0) & (F.get(pairs, i - 1)["h"] == p["h"])) | ((i < n - 1) & (F.get(pairs, i + 1)["h"] == p["h"]))))
        return F.sort_array(F.transform(again, lambda p: p["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda total, n: total + n)

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(pairs, lambda p: _let(places(p), covered))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _once(value: Column) -> Column:
    """``value`` behind a generator of one row: the optimizer copies an
    expression into each place that uses it, but not over a generator."""
    return F.explode(F.array(value))


def _joined(h: Column, step: int) -> Column:
    """Hashes of windows of twice the width, from those of ``step`` words."""
    return F.transform(F.slice(h, 1, F.greatest(F.lit(0), F.size(h) - step)), lambda x, i: F.xxhash64(x, F.get(h, i + step)))


def _share(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return _let(total, lambda t: F.transform(counts, lambda x: F.when(t > 0, x / t).otherwise(0.0)))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance of two histograms (arrays of shares), 0 to 1."""
    def term(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: term(a, (a + b) / 2) + term(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))


def common_words(docs: DataFrame, most: int = COMMON_WORDS) -> DataFrame:
    """l (the language), common: ``LISTS`` lists by a part of the hash, of its
    most frequent words' hashes with the bin in the lowest bits."""
    words = docs.select("lang", F.explode(words_of(text_or_empty())).alias("word"))
    counted = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    # the most frequent ones of each part of a language's words, then of all: no task ranks a whole language
    part, order = F.pmod(F.xxhash64("word"), F.lit(PARTS)), [F.desc("n"), F.col("word")]
    top = counted.withColumn("place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("place") <= most)
    top = top.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order)) - 1).where(F.col("place") < most)
    # from OWN_BINS on, one bin for each number of binary digits of the place
    shared = F.length(F.bin("place")) + (OWN_BINS - OWN_BINS.bit_length())
    own = F.when(F.col("place") < OWN_BINS, F.col("place")).otherwise(shared)
    code = F.xxhash64("word").bitwiseAND(F.lit(-1 << BIN_BITS)).bitwiseOR(own.cast("long"))
    top = top.groupBy("lang").agg(F.collect_list(code).alias("top"))  # ``most`` hashes
    lists = F.transform(F.sequence(F.lit(0), F.lit(LISTS - 1)), lambda i: F.filter("top", lambda x: _list_of(x) == i))
    return top.select(F.col("lang").alias("l"), lists.alias("common"))


def document_counts(docs: DataFrame, with_row: bool = False) -> DataFrame:
    """doc_id, lang, the counts of each document, ``classes`` and ``words``
    (how often words of each bin occur), written to the shared folder."""
    known = write_shared(common_words(docs), "common-words")
    rows = docs.select("doc_id", "lang", text_or_empty().alias("__text"), *([F.struct("*").alias(ROW)] if with_row else []))
    rows = rows.join(known, rows["lang"].eqNullSafe(known["l"]), "left")
    text, common = F.col("__text"), F.col("common")
    by_word = _let(words_of(text), lambda words: F.struct(*[c.alias(k) for k, c in word_counts(text, words, common).items()]))
    counts = F.struct(by_word.alias("w"), *[c.alias(k) for k, c in text_counts(text).items()])
    rows = rows.withColumn("c", _once(counts)).select("doc_id", "lang", "c.*", *([ROW] if with_row else [])).select("*", "w.*").drop("w").select("*", "by_hash.*").drop("by_hash")
    letter = F.col("word_chars") - F.col("capital") - F.col("digit") - F.col("sign")
    classes = [letter, F.col("capital"), F.col("digit"), F.col("n_chars") - F.col("word_chars"), F.col("sign")]
    rows = rows.withColumn("classes", F.array(*[c.cast("double") for c in classes]))
    return write_shared(rows, "quality-counts")


def quality(docs: DataFrame, min_words: int = MIN_WORDS, max_class_distance: float = MAX_CLASS_DISTANCE,
            max_word_distance: float = MAX_WORD_DISTANCE, max_word_share: float = MAX_WORD_SHARE, min_reference_words: int = MIN_REFERENCE_WORDS, with_row: bool = False) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    class_distance, word_distance, base_failed, kept; with the whole row of
    ``docs`` as a struct if ``with_row``."""
    rows = document_counts(docs, with_row)
    sums = rows.groupBy("lang").agg(
        F.sum("n_words").alias("total"),
        F.array(*[F.sum(F.col("classes")[i]) for i in range(len(CLASSES))]).alias("classes"),
        F.array(*[F.sum(F.get("words", F.lit(i))) for i in range(OTHERS + 1)]).alias("words"))
    refs = sums.where(F.col("total") >= min_reference_words).select(
        F.col("lang").alias("l"), _share(F.col("classes")).alias("ref_classes"),
        _share(F.col("words")).alias("ref_words"))
    without = F.array(*[F.lit(0.0)] * OTHERS, F.lit(1.0))
    refs = refs.withColumn("max_word_distance", F.least(F.lit(max_word_distance), max_word_share * jensen_shannon(without, F.col("ref_words"))))
    # one small row for each language, written: Spark then knows its size, and broadcasts it while it is small
    refs = write_shared(refs, "quality-references")
    rows = rows.join(refs, rows["lang"].eqNullSafe(refs["l"]), "left")
    n, known = F.col("n_words"), F.col("ref_classes").isNotNull()
    distances = F.struct(F.when(known, jensen_shannon(_share(F.col("classes")), F.col("ref_classes"))).alias("class_distance"),
                         F.when(known, jensen_shannon(_share(F.col("words")), F.col("ref_words"))).alias("word_distance"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = rows.withColumn("d", _once(distances)).select(
        "doc_id", *names, "d.class_distance", "d.word_distance", "max_word_distance",
        ((n < 20) | (F.col("n_repeat_words") * 100 > n * 30)).alias("base_failed"), *([ROW] if with_row else []))
    diverges = (F.col("n_words") >= min_words) & (
        (F.coalesce("class_distance", F.lit(0.0)) > max_class_distance) | F.coalesce(F.col("word_distance") > F.col("max_word_distance"), F.lit(False)))
    return rows.withColumn("kept", ~F.col("base_failed") & ~diverges).drop("max_word_distance")


def keep_good(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    return quality(docs, with_row=True, **params).where("kept").select(f"{ROW}.*")
