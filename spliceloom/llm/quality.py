"""Quality rules: base counts, and divergence of a text from its language."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, words

# Shares of character classes in ordinary prose (lower-case and other letters, upper-case letters,
# digits, separators, common punctuation, symbols of mark-up, all other characters).
CLASSES = ("letters", "upper", "digits", "spaces", "points", "symbols")
CLASS_SHARES = {
    "en": (0.770, 0.025, 0.010, 0.170, 0.024, 0.001),
    "de": (0.765, 0.045, 0.010, 0.150, 0.029, 0.001),
    "fr": (0.765, 0.025, 0.010, 0.170, 0.029, 0.001),
    "es": (0.770, 0.022, 0.010, 0.170, 0.027, 0.001),
}
# Shares of common words among all words of a language, in per cent.
WORD_SHARES = {
    "en": {"the": 6.0, "of": 3.0, "and": 2.8, "to": 2.5, "in": 2.1, "a": 2.1, "is": 1.1, "that": 1.1, "for": 0.9, "it": 0.9, "was": 0.8, "on": 0.7, "with": 0.7, "as": 0.7, "be": 0.6, "by": 0.5},
    "de": {"der": 3.5, "die": 3.5, "und": 3.0, "in": 1.9, "den": 1.3, "von": 1.1, "zu": 1.1, "das": 1.0, "mit": 0.9, "ist": 0.9, "des": 0.8, "im": 0.8, "auf": 0.7, "nicht": 0.7, "dem": 0.7, "ein": 0.6},
    "fr": {"de": 5.0, "la": 3.2, "le": 2.5, "et": 2.3, "les": 2.2, "des": 1.8, "en": 1.5, "un": 1.2, "une": 1.1, "du": 1.1, "dans": 1.0, "est": 1.0, "que": 1.0, "pour": 0.9, "qui": 0.8, "au": 0.7},
    "es": {"de": 5.5, "la": 3.8, "que": 3.0, "el": 2.8, "en": 2.6, "y": 2.5, "a": 1.9, "los": 1.6, "se": 1.2, "del": 1.1, "las": 1.0, "un": 0.9, "por": 0.9, "con": 0.9, "no": 0.8, "una": 0.8},
}
MIN_CHARS = 100   # shorter texts get no verdict on characters
MIN_WORDS = 50    # shorter texts get no verdict on words
MAX_CHAR_JS = 0.12  # bits
WORD_PART = 0.8     # limit of the word divergence, as a part of what a text with no common word of its language has
BOTH_PART = 0.9     # the same for the sum of the two


def class_counts(text: Column, rest: Column) -> Column:
    """Array of code points: all, upper, digits, separators, points, symbols; ``rest`` is the text without lower-case letters and blanks.

    Characters of no class count as letters. Most of a text goes in one run-wise pass; the patterns then read the few left."""
    def count(chars: str) -> Column:
        return F.regexp_count(rest, F.lit(f"[{chars}]"))
    blanks = F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))
    return F.array(F.char_length(text), count(r"\p{Lu}"), count("0-9"), blanks + count(r"\t-\r"), count(r".,;:!?'\"()-"), count("#*$%&|<>"))


def js_term(p: Column, q: Column) -> Column:
    """One bin's part of the Jensen-Shannon divergence in bits."""
    m = (p + q) / 2
    return (F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0)) + F.when(q > 0, q * F.log2(q / m)).otherwise(F.lit(0.0))) / 2


def window_hashes(w: Column, h: Column, width: int = 5) -> Column:
    """Hash of the window of ``width`` words from each place on; ``h`` holds the hash of each word."""
    return F.when(F.size(w) < width, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - width, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)])))


def in_hash_order(hashes: Column) -> Column:
    """Hash and place in hash order; left out where no hash occurs twice."""
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))


def repeated_starts(s: Column) -> Column:
    """Ascending places whose hash occurs at least twice: in hash order, equal ones are neighbours."""
    runs = F.zip_with(s, F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0))), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(runs, lambda r: r.isNotNull()))))
    return F.when(s.isNull(), F.array().cast("array<int>")).otherwise(starts)


def covered(starts: Column, width: int = 5) -> Column:
    """Number of places covered by windows of ``width`` from ascending starts."""
    steps = F.zip_with(starts, F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width))))
    return F.aggregate(steps, F.lit(0), lambda x, y: x + y)


def bare_js(code: str) -> float:
    """Word divergence, in bits, of a text with no common word of the language: p is 1 for all other words, 0 elsewhere."""
    q = 1 - sum(WORD_SHARES[code].values()) / 100
    return (math.log2(2 / (1 + q)) + q * math.log2(2 * q / (1 + q)) + 1 - q) / 2


def by_language(lang: Column, of) -> Column:
    """CASE over the reference languages; null for any other."""
    out = None
    for code in WORD_SHARES:
        out = F.when(lang == code, of(code)) if out is None else out.when(lang == code, of(code))
    return out


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS,
                  max_char_js: float = MAX_CHAR_JS, max_word_js: float | None = None, max_both_js: float | None = None) -> DataFrame:
    """Base counts of every whole text, its divergence from the references of its language, and the verdict.

    Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (long), ``base_failed``,
    ``char_js``, ``word_js`` (double, bits) and ``kept``; input columns with one of these names are replaced.
    All work is inside the row and nothing is shuffled, so a hot source or a repeated id changes nothing.
    A null or empty text has no words and fails the base rule. A language without a reference, or null, and a text
    below the length guards get null divergences and no verdict beyond the base rule. The limits of the word divergence and
    of the sum are parts of ``bare_js`` of the language (WORD_PART, BOTH_PART), unless given in bits.
    """
    names = fresh(docs, "_t", "_w", "_h", "_lines", "_cls", "_starts", "_low", "_q", "_rest")
    t, w, h, lines, cls, starts, low, q, rest = (F.col(x) for x in names)
    code = F.col(lang)
    df = docs.withColumn(names[0], F.coalesce(F.col(text).cast("string"), F.lit("")))
    df = df.withColumns({names[1]: words(t), names[3]: F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^ \\t-\\r]")), names[8]: F.regexp_replace(t, r"[\p{Ll} ]+", "")})
    # a word counts as written in the list or at the start of a sentence
    df = df.withColumns({names[4]: class_counts(t, rest), names[2]: F.transform(w, lambda x: F.xxhash64(x)),
                         names[6]: by_language(code, lambda c: F.filter(w, lambda x: x.isin(*WORD_SHARES[c], *(k.capitalize() for k in WORD_SHARES[c]))))})
    df = df.withColumns({names[2]: window_hashes(w, h), names[6]: F.transform(low, lambda x: F.lower(x))})
    df = df.withColumn(names[5], in_hash_order(h))
    df = df.withColumns({names[5]: repeated_starts(starts), names[7]: by_language(code, lambda c: F.array(*[F.struct(F.lit(k).alias("w"), F.lit(v / 100).alias("q")) for k, v in WORD_SHARES[c].items()]))})
    df = df.withColumns({"n_words": F.size(w).cast("long"), "word_chars": (cls[0] - cls[3]).cast("long"), "n_symbols": cls[5].cast("long"),
                         "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"), "n_repeat_words": covered(starts).cast("long")})
    n, total = F.col("n_words"), cls[0]
    shares = [(total - cls[1] - cls[2] - cls[3] - cls[4] - cls[5]) / total, *[cls[i] / total for i in range(1, 6)]]
    char_js = by_language(code, lambda c: sum((js_term(p, F.lit(q)) for p, q in zip(shares, CLASS_SHARES[c])), F.lit(0.0)))
    other = by_language(code, lambda c: js_term(1 - F.size(low) / n, F.lit(1 - sum(WORD_SHARES[c].values()) / 100)))
    bins = F.transform(q, lambda r: F.struct(((F.size(low) - F.size(F.array_remove(low, r["w"]))) / n).alias("p"), r["q"].alias("q")))
    word_js = F.aggregate(bins, other, lambda a, r: a + js_term(r["p"], r["q"]))
    df = df.withColumns({"base_failed": (n < 10) | (100 * F.col("n_repeat_words") > 20 * n), "char_js": F.when(total >= min_chars, char_js), "word_js": F.when(n >= min_words, word_js)})
    bad = F.lit(False)
    most = lambda given, part: F.lit(given) if given is not None else by_language(code, lambda c: F.lit(part * bare_js(c)))
    for far in (F.col("char_js") > max_char_js, F.col("word_js") > most(max_word_js, WORD_PART), F.col("char_js") + F.col("word_js") > most(max_both_js, BOTH_PART)):
        bad = bad | F.coalesce(far, F.lit(False))
    # tied to a row number, which no filter passes: a filter on the verdict would else sink below the columns it is built from and compute them many times
    return df.withColumn("kept", ~F.col("base_failed") & ~bad & (F.monotonically_increasing_id() >= 0)).drop(*names)


def accepted(docs: DataFrame, text: str = "text", lang: str = "lang", **rules: float) -> DataFrame:
    """The documents that ``quality_rules`` keeps, with their own columns alone."""
    name = fresh(docs, "_kept")[0]
    own = docs.select(F.col(text).alias(name + "_text"), F.col(lang).alias(name + "_lang"), F.struct(*docs.columns).alias(name + "_row"))
    return quality_rules(own, name + "_text", name + "_lang", **rules).filter("kept").select(name + "_row.*")
