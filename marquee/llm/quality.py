"""Quality rules: distribution divergence from language references.

Two histograms of a document, its character classes and its common words, are
compared with those of its language by the Jensen-Shannon distance (base 2, 0
to 1).  The references are counted over all documents of a language in one
aggregate.  A document is judged only if it is long enough for its histogram
to mean something (``LEAST_CHARS``, ``LEAST_WORDS``).

Everything is DataFrame expressions; a document never leaves its row, so no
text is shuffled.  The references (one row per language) are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import SPACE, stored, words

# Function words that are common in each language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son ou aux elle".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si".split(),
}
_ALL_COMMON = sorted({w for ws in COMMON_WORDS.values() for w in ws})
# Character classes.  White space and a-z are taken out of a text first, then these in order; "other" is what is left.
CLASS_PATTERNS = {"upper": "[A-Z]+", "digit": "[0-9]+", "symbol": r"[#*$%&|<>]+", "punct": r"[\x21-\x7E]+"}
CHAR_CLASSES = ("space", "lower", *CLASS_PATTERNS, "other")
#: Documents with fewer are not judged by that histogram.
LEAST_CHARS, LEAST_WORDS = 200, 100
#: Largest distances of a document that is kept.
MOST_CHAR_DISTANCE, MOST_WORD_DISTANCE = 0.25, 0.31
#: Decimals of the reported distances.
DIGITS = 9


def let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), fn)[0]


def repeat_words(ws: Column) -> Column:
    """Words of the array inside three-word windows that occur twice or more in it, the first occurrence included.

    Windows are sorted by hash with their positions, so equal ones are
    neighbours; each marked window then adds the words up to the next one."""
    n = F.size(ws)
    pair = F.zip_with(ws, F.slice(ws, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    triple = F.zip_with(pair, F.slice(ws, F.lit(3), F.greatest(n - 2, F.lit(0))), lambda h, c: F.xxhash64(h, c))
    windows = F.slice(triple, F.lit(1), F.greatest(n - 2, F.lit(0)))

    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = let(ordered, lambda s: F.filter(
            s, lambda x, i: x["h"].eqNullSafe(F.get(s, i - 1)["h"]) | x["h"].eqNullSafe(F.get(s, i + 1)["h"])))
        return let(F.sort_array(F.transform(repeated, lambda x: x["i"])), lambda p: F.aggregate(
            F.zip_with(p, F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))),
            F.lit(0).cast("long"), lambda t, x: t + x))

    # most texts repeat no window: those need no sort
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))))


def _common(lang: Column) -> Column:
    """The common words that a document of this language is compared on; an unknown language has those of all."""
    out = F.array(*[F.lit(w) for w in _ALL_COMMON])
    for code, ws in COMMON_WORDS.items():
        out = F.when(lang == code, F.array(*[F.lit(w) for w in ws])).otherwise(out)
    return out


def measures(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with one struct column __m: the base counts and both histograms (arrays of long)."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select("*", t.alias("__t")).withColumn("__w", words(F.col("__t")))
    # strip one class after another, so each step only sees what is left
    out = out.withColumn("__chars_in_words", F.length(F.array_join("__w", "")).cast("long"))
    space = F.length("__t") - F.col("__chars_in_words")
    out = out.withColumn("__rest", F.regexp_replace("__t", f"[a-z{SPACE}]+", ""))
    counts = {"space": space, "lower": F.col("__chars_in_words") - F.length("__rest")}
    left = F.col("__rest")
    for name, pattern in CLASS_PATTERNS.items():
        out = out.withColumn(f"__{name}", F.regexp_replace(left, pattern, ""))
        counts[name] = (F.length(left) - F.length(f"__{name}")).cast("long")
        left = F.col(f"__{name}")
    counts["other"] = F.length(left).cast("long")
    counts = {k: v.cast("long") for k, v in counts.items()}
    lines = F.filter(F.split(F.col("__t"), "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    hits = F.array_join(F.filter(F.col("__w"), lambda w: w.isin(_ALL_COMMON)), "  ")
    found = let(F.concat(F.lit(" "), hits, F.lit(" ")), lambda h: F.transform(_common(F.col(lang_col)), lambda c: (
        (F.length(h) - F.length(F.replace(h, F.concat(F.lit(" "), c, F.lit(" ")), F.lit("")))) / (F.length(c) + 2)).cast("long")))
    n = F.size("__w").cast("long")
    return out.select(*docs.columns, F.struct(
        n.alias("n_words"), F.col("__chars_in_words").alias("word_chars"), counts["symbol"].alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("__w")).alias("n_repeat_words"), F.length("__t").cast("long").alias("n_chars"),
        F.array(*[counts[c] for c in CHAR_CLASSES]).alias("chars"),
        let(found, lambda x: F.concat(x, F.array(n - F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)))).alias("common"),
    ).alias("__m"))


def _js(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms of counts of the same length; null if one is empty."""
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    mean = lambda x, y: (x + y) / 2
    share = lambda h: let(total(h), lambda n: F.transform(h, lambda x: x / F.nullif(n, F.lit(0).cast("long"))))
    terms = F.zip_with(share(p), share(q), lambda x, y: (part(x, mean(x, y)) + part(y, mean(x, y))) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, b: a + b), F.lit(0.0)))


def _references(measured: DataFrame, lang_col: str) -> DataFrame:
    """One row per language: both histograms summed over all its documents."""
    sums = lambda field, n: F.array(*[F.sum(F.get(F.col(f"__m.{field}"), F.lit(i))) for i in range(n)])
    width = max(len(_ALL_COMMON), *map(len, COMMON_WORDS.values())) + 1
    return (measured.groupBy(F.col(lang_col).alias("__lang"))
            .agg(sums("chars", len(CHAR_CLASSES)).alias("__chars"), sums("common", width).alias("__common"))
            .withColumn("__common", F.filter("__common", lambda x: x.isNotNull())))


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` (all columns) with __m, __q: base_failed, js_chars, js_words, kept.

    base_failed: fewer than 50 words, or over half of the words in repeated
    three-word windows.  kept: not base_failed, and each distance that applies
    at most its limit.  Null and empty texts have no words and fail.  Documents
    of a null or unknown language are compared with the reference of all rows
    of that same value, on the common words of all languages.  Repeated rows
    are judged alike; extra columns are carried along; an empty table gives an
    empty result."""
    return _verdicts(measures(docs, text_col, lang_col), docs.columns, lang_col)


def _verdicts(measured: DataFrame, columns: list[str], lang_col: str) -> DataFrame:
    references = stored(_references(measured, lang_col), "references")
    joined = measured.join(references, F.col(lang_col).eqNullSafe(F.col("__lang")), "left")
    m = F.col("__m")
    chars = F.when(m["n_chars"] >= LEAST_CHARS, F.round(_js(m["chars"], F.col("__chars")), DIGITS))
    common = F.when(m["n_words"] >= LEAST_WORDS, F.round(_js(m["common"], F.col("__common")), DIGITS))
    failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    far = (F.coalesce(F.col("__jc"), F.lit(0.0)) > MOST_CHAR_DISTANCE) | (F.coalesce(F.col("__jw"), F.lit(0.0)) > MOST_WORD_DISTANCE)
    return (joined.withColumn("__jc", chars).withColumn("__jw", common)
            .select(*columns, "__m", F.struct(failed.alias("base_failed"), F.col("__jc").alias("js_chars"),
                                                   F.col("__jw").alias("js_words"), (~failed & ~far).alias("kept")).alias("__q")))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The counts and the verdict of every document; see ``judge``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    # without the texts the measures are small: they are stored, so texts are read once
    j = _verdicts(stored(measures(rows).drop("text"), "measures"), ["doc_id", "lang"], "lang")
    return j.select("doc_id", *[f"__m.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    "__q.base_failed", "__q.kept", "__q.js_chars", "__q.js_words")


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they are, whatever their names."""
    # the row travels as one column, so no column name can clash
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return judge(rows).where("__q.kept").select("row.*")
