"""Quality rules: counts of words, symbols and repeats, and divergence from language references; DataFrame functions only.

Base rules reject texts of under MIN_WORDS words, and those of whose words more than half are in three-word windows
that the text repeats. The others are compared with references: for each language, the summed histograms of all texts
that pass the base rules, over classes of characters and over the language's common words. The verdict is by the
Jensen-Shannon distances (base 2, from 0 to 1) of the text's own histograms, against limits that widen for short texts;
either counts only where the text has MIN_CHARS characters or MIN_JUDGED words, below which its histogram tells little.

One pass over the texts makes the counts, which are stored; references are sums over that table, one row a language. A
language (null is one, too) of fewer than MIN_TEXTS such texts is no reference for itself: its texts are compared with
the sums over all languages, in their characters only. References come from the table itself, so a text's verdict can
differ between tables. Within a text, windows are found twice by sorting 64-bit hashes of its windows.

Defined results: a null or empty text has no words and fails. A language without a list of common words is compared in
its characters only; a distance that has no reference is 0. Rows with equal doc_id, and equal rows, are judged each, alike where they are equal. Texts of any
length are judged whole. Other columns stay or are ignored, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlink.llm.common import documents, stored

MIN_WORDS, MIN_CHARS, MIN_JUDGED = 50, 200, 50
MIN_TEXTS = 20
#: Limits are base + spread / sqrt(words): chance moves the histogram of a short text by as much.
CHAR_LIMIT, WORD_LIMIT = (0.17, 0.8), (0.22, 0.9)
WHITE = " \t\n\x0b\f\r"
WHITE_CLASS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Common words by language (fixed values: articles, prepositions, conjunctions and forms of "to be").
COMMON = {
    "en": "the of and to in a is that for it as was with be by on not are this from or an at which".split(),
    "fr": "le la les de du des et en un une que qui est par pour pas sur au aux avec dans ce il ne".split(),
    "de": "der die das und in von zu den mit ist nicht ein eine für auf dem des sich als auch es an im bei".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o".split(),
}
N_COMMON = 24
CODES = "".join(chr(64 + k) for k in range(N_COMMON + 1))  # @ for other words
CLASSES = ["spaces", "capitals", "digits", "marks", "symbols", "letters"]
_COUNTED = {"capitals": r"[A-ZÀ-ÖØ-Þ]", "digits": r"[0-9]", "marks": r"[.,;:!?'\"()-]"}


def counts(df: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` (of df) and _lang, with the counts of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_CLASS))
    lists = reduce(lambda c, k: c.when(F.col("lang") == k, F.array(*map(F.lit, COMMON[k]))), COMMON, F.when(F.lit(False), F.array().cast("array<string>")))
    df = df.select(*[quoted(c).alias(f"_k{n}") for n, c in enumerate(keep)], F.col("lang").alias("_lang"), text.alias("_t"), words.alias("_w"), lists.alias("_common"))

    def windows(w: Column) -> Column:
        return F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))).otherwise(F.array().cast("array<bigint>"))

    def repeated(h: Column) -> Column:
        """Places of the windows whose hash occurs again: sorted with their places, they are beside each other."""
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = F.transform(F.array(placed), lambda p: F.filter(p, lambda x, k: F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False))))[0]
        covered = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return F.size(F.array_distinct(covered))

    lines = F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    code = lambda w: F.when(F.octet_length(w) <= 9, F.substr(F.lit(CODES), F.coalesce(F.array_position("_common", F.rtrim(F.lower(w), F.lit(".,;:!?"))), F.lit(0)).cast("int") + 1, F.lit(1))).otherwise("@")
    coded = F.when(F.col("_common").isNotNull(), F.array_join(F.transform("_w", code), ""))
    df = df.select(
        *[f"_k{n}" for n in range(len(keep))],
        "_lang",
        F.char_length("_t").alias("_chars"),
        F.size("_w").alias("_n"),
        F.char_length(F.array_join("_w", "")).alias("_word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).alias("_symbols"),
        *[F.regexp_count("_t", F.lit(p)).alias(f"_{c}") for c, p in _COUNTED.items()],
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].alias("_lines"),
        F.transform(F.array(windows(F.col("_w"))), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), repeated(h)).otherwise(F.lit(0)))[0].alias("_repeats"),
        coded.alias("_coded"),
    )
    letters = F.col("_word_chars") - F.col("_capitals") - F.col("_digits") - F.col("_marks") - F.col("_symbols")
    classes = F.array(*[x.cast("double") for x in (F.col("_chars") - F.col("_word_chars"), F.col("_capitals"), F.col("_digits"), F.col("_marks"), F.col("_symbols"), letters)])
    common = F.when(F.col("_coded").isNotNull(), F.array(*[(F.char_length("_coded") - F.char_length(F.replace("_coded", F.lit(c)))).cast("double") for c in CODES]))
    failed = (F.col("_n") < MIN_WORDS) | (100 * F.col("_repeats").cast("long") > 50 * F.col("_n").cast("long"))
    plain = [F.col(a).cast("long").alias(b) for a, b in (("_n", "_n_words"), ("_word_chars", "_word_chars"), ("_symbols", "_n_symbols"), ("_lines", "_n_dup_lines"), ("_repeats", "_n_repeat_words"))]
    return df.select(*[f"_k{n}" for n in range(len(keep))], "_lang", "_chars", *plain, failed.alias("_failed"), classes.alias("_classes"), common.alias("_words"))


def references(counted: DataFrame) -> DataFrame:
    """(_of, _class_sums, _word_sums): sums over the texts that pass the base rules, a row for each language that has
    MIN_TEXTS of them, and a row marked _all with the sums of all languages' characters."""
    n, m = range(len(CLASSES)), range(len(CODES))
    sums = [F.sum(F.col("_classes")[k]).alias(f"c{k}") for k in n] + [F.sum(F.col("_words")[k]).alias(f"w{k}") for k in m]
    summed = stored(counted.where("not _failed").groupBy("_lang").agg(F.count("*").alias("_texts"), *sums), "sums")
    own = summed.where(F.col("_texts") >= MIN_TEXTS).select(F.lit(False).alias("_all"), F.col("_lang").alias("_of"), F.array(*[f"c{k}" for k in n]).alias("_class_sums"), F.array(*[f"w{k}" for k in m]).alias("_word_sums"))
    every = summed.agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in n]).where("c0 is not null")
    return own.union(every.select(F.lit(True), F.lit(None).cast("string"), F.array(*[f"c{k}" for k in n]), F.lit(None).cast("array<double>")))


def distance(own: str, reference: str) -> Column:
    """Jensen-Shannon distance of two histograms (arrays of counts), to nine digits."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)

    def term(a: Column, b: Column) -> Column:
        m = (a + b) / 2
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0) + F.when(b > 0, b * F.log2(b / m)).otherwise(0.0)

    both = F.array(F.struct(total(own).alias("p"), total(reference).alias("q")))
    sums = F.transform(both, lambda t: total(F.zip_with(own, reference, lambda x, y: term(x / t["p"], y / t["q"]))))
    return F.round(F.sqrt(F.greatest(sums[0] / 2, F.lit(0.0))), 9)


def quoted(c: str) -> Column:
    """The column of exactly this name."""
    return F.col("`" + c.replace("`", "``") + "`")


def judge(df: DataFrame, keep: list[str]) -> DataFrame:
    """`_kept`, a struct of the columns `keep` of df (doc_id, text, lang, ...), and `_q`, one of the counts, distances and
    verdict of each text."""
    counted = stored(counts(df, keep), "counts")
    known = stored(references(counted), "references")
    every = known.where("_all").select(F.col("_class_sums").alias("_all_sums"))
    both = counted.join(known.where("not _all"), F.col("_lang").eqNullSafe(F.col("_of")), "left").join(F.broadcast(every), how="left")  # one row
    both = both.withColumn("_class_sums", F.coalesce("_class_sums", "_all_sums"))
    char = F.when(F.col("_chars") >= MIN_CHARS, distance("_classes", "_class_sums"))
    word = F.when(F.col("_n_words") >= MIN_JUDGED, distance("_words", "_word_sums"))
    both = both.withColumn("_char", char).withColumn("_word", word)
    over = lambda c, limit: F.coalesce(F.col(c) > limit[0] + limit[1] / F.sqrt(F.col("_n_words").cast("double")), F.lit(False))
    far = over("_char", CHAR_LIMIT) | over("_word", WORD_LIMIT)
    verdict = F.struct(
        *[F.col(f"_{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("_failed").alias("base_failed"),
        (~F.col("_failed") & ~far).alias("kept"),
        F.col("_char").alias("char_distance"),
        F.col("_word").alias("word_distance"),
    )
    kept = F.struct(*[F.col(f"_k{n}").alias(c) for n, c in enumerate(keep)]) if keep else F.lit(None)
    return both.select(kept.alias("_kept"), verdict.alias("_q"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir).select("doc_id", "text", "lang"), ["doc_id"]).select("_kept.*", "_q.*")


def _sql() -> str:
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    lists = " ".join(f"WHEN '{k}' THEN [{', '.join(repr(w) for w in v)}]" for k, v in COMMON.items())
    per_class = {"spaces": "length(t) - word_chars", "capitals": "", "digits": "", "marks": "", "symbols": "n_symbols"}
    for c, p in _COUNTED.items():
        per_class[c] = "len(regexp_extract_all(t, '" + p.replace("'", "''").replace('\\"', '"') + "'))"
    classes = ", ".join(f"CAST({v} AS DOUBLE)" for v in per_class.values())

    def js(a: str, b: str, n: int) -> str:
        term = lambda x, y: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / (({x} + {y}) / 2)) ELSE 0.0 END"
        parts = [f"({term(f'({a}[{k}] / list_sum({a}))', f'({b}[{k}] / list_sum({b}))')} + {term(f'({b}[{k}] / list_sum({b}))', f'({a}[{k}] / list_sum({a}))')})" for k in range(1, n + 1)]
        return f"round(sqrt(greatest(({' + '.join(parts)}) / 2, 0.0)), 9)"

    n, m = len(CLASSES), len(CODES)
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, CASE lang {lists} END AS common FROM documents),
w AS (SELECT row_number() OVER () AS r, *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: trim(x, {white}) <> '') AS lines FROM d),
g AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) AS g FROM w WHERE len(w) >= 3),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
c AS (SELECT w.*, coalesce(n, 0) AS n_repeat_words, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  len(regexp_extract_all(t, '{SYMBOLS}')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  list_transform(w, lambda x: CASE WHEN strlen(x) <= 9 THEN coalesce(list_position(common, rtrim(lower(x), '.,;:!?')), 0) ELSE 0 END) AS coded FROM w LEFT JOIN covered USING (r)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  [{classes}] AS five,
  CASE WHEN common IS NOT NULL THEN list_transform(range(0, {m}), lambda k: CAST(len(list_filter(coded, lambda x: x = k)) AS DOUBLE)) END AS words FROM c),
h AS (SELECT *, list_append(five, CAST(length(t) AS DOUBLE) - list_sum(five)) AS classes FROM f),
s AS (SELECT lang AS of, count(*) AS texts, [{', '.join(f'sum(classes[{k}])' for k in range(1, n + 1))}] AS class_sums, [{', '.join(f'sum(words[{k}])' for k in range(1, m + 1))}] AS word_sums FROM h WHERE NOT base_failed GROUP BY lang),
a AS (SELECT [{', '.join(f'sum(class_sums[{k}])' for k in range(1, n + 1))}] AS all_sums FROM s),
l AS (SELECT h.*, coalesce(s.class_sums, all_sums) AS class_sums, word_sums FROM h LEFT JOIN s ON lang IS NOT DISTINCT FROM of AND texts >= {MIN_TEXTS}, a),
j AS (SELECT *, CASE WHEN length(t) >= {MIN_CHARS} THEN {js('classes', 'class_sums', n)} END AS char_distance,
  CASE WHEN n_words >= {MIN_JUDGED} THEN {js('words', 'word_sums', m)} END AS word_distance FROM l)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (coalesce(char_distance > {CHAR_LIMIT[0]} + {CHAR_LIMIT[1]} / sqrt(CAST(n_words AS DOUBLE)), false)
  OR coalesce(word_distance > {WORD_LIMIT[0]} + {WORD_LIMIT[1]} / sqrt(CAST(n_words AS DOUBLE)), false)) AS kept,
  char_distance, word_distance
FROM j"""


QUERIES = {"op2_quality_rules": op2_quality_rules}
SQL = {"op2_quality_rules": _sql()}
