"""Spelling variant grouping: words one edit apart, found by asymmetric q-chunks.

Of two words that are one edit apart the longer one (or either, if they are
equally long) is cut into two disjoint chunks, its halves.  The edit touches
one half; the other is preserved and is a gram of the partner at the same
place, or shifted by the one code point that the lengths differ by.  Halves
are shared by thousands of words ("-tion"), so such lists are split by the
same rule once more: the touched half is cut into two chunks, of which one is
preserved too.  The chunk word thus posts four keys for each partner length,
each leaving out one quarter; the gram word posts its grams at the places
where a chunk of such a word can stand (no other gram can meet a chunk within
a shift of one).  Candidates are verified by edit distance; a pair that meets
under several quarters is taken at the first.

Everything is DataFrame code: counts are combined before the shuffle, a list
of the join is split by AQE if it is hot, and no list is gathered.  Keys are
hashes, so long words cost what their verification costs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(text: Column) -> Column:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; null for null."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("[a-zÀ-ÿ]+"), F.lit(0))


def mistyped(doc_id: Column, run: Column, every: int) -> Column:
    """The run, or the run less one code point where the crc32 of ``<doc_id>:<run>``
    is a multiple of ``every``: the code point at that crc32 modulo the length
    (a null id counts as "")."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def count_words(words: DataFrame, word: str = "word", min_chars: int = 5, min_count: int = 3) -> DataFrame:
    """``word, n`` of words of ``min_chars`` code points or more that occur ``min_count`` times or more (nulls never)."""
    return (words.where(F.char_length(word) >= min_chars).groupBy(F.col(word).alias("word"))
                 .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _bounds(length: Column) -> list[Column]:
    """Where the quarters of a word begin, and its end."""
    half = F.floor(length / 2)
    return [F.lit(0), F.floor(half / 2), half, half + F.floor((length - half) / 2), length]


def _around(word: Column, length: Column, partner: Column, quarter: int) -> tuple[Column, Column]:
    """What of ``word`` (``length`` code points) stands before and behind the
    left-out ``quarter`` of a chunk word of ``partner`` code points."""
    b = [x.cast("int") for x in _bounds(partner)]
    before = F.substring(word, F.lit(1), b[quarter])
    rest = b[4] - b[quarter + 1]
    return before, F.substring(word, length - rest + 1, rest)


def _keys(words: DataFrame, sign: int) -> DataFrame:
    """``key, quarter, shift, word, n``: what words post as chunk words
    (``sign`` 0: partners as long or one shorter) or as gram words (``sign`` 1:
    partners as long or one longer)."""
    size = F.col("size")
    posts = []
    for shift in (0, 1):
        chunked = size + shift * sign
        for q in range(4):
            before, behind = _around(F.col("word"), size, chunked, q)
            posts.append(F.struct(F.xxhash64(F.lit(4 * shift + q), chunked, before, behind).alias("key"),
                                  F.lit(q).alias("quarter"), F.lit(shift).alias("shift")))
    sized = words.select("word", "n", F.char_length("word").alias("size"))
    return sized.select("word", "n", F.explode(F.array(*posts)).alias("p")).select("p.key", "p.quarter", "p.shift", "word", "n")


def near_pairs(words: DataFrame) -> DataFrame:
    """``x, nx, y, ny``: each pair of distinct words (``word, n``) that differ by
    exactly one inserted, deleted or replaced code point, once; x is not shorter."""
    chunk = _keys(words, 0).select("key", "quarter", "shift", F.col("word").alias("x"), F.col("n").alias("nx"))
    gram = _keys(words, 1).select("key", "quarter", "shift", F.col("word").alias("y"), F.col("n").alias("ny"))
    met = chunk.join(gram, ["key", "quarter", "shift"]).where("shift = 1 or x < y")
    lx, ly = F.char_length("x"), F.char_length("y")
    first = F.lit(3)
    for q in (2, 1, 0):  # the first quarter whose surroundings agree
        own, other = _around(F.col("x"), lx, lx, q), _around(F.col("y"), ly, lx, q)
        first = F.when((own[0] == other[0]) & (own[1] == other[1]), F.lit(q)).otherwise(first)
    return met.where((F.levenshtein("x", "y", 1) == 1) & (F.col("quarter") == first)).select("x", "nx", "y", "ny")


def near_forms(words: DataFrame, ratio: int = 2) -> DataFrame:
    """``word, n, n_near, form, form_n`` for every row of ``words`` (distinct
    ``word``, ``n``): the number of near words, and the near word of largest n
    (of equal ones the smallest in code-point order) if its n is at least
    ``ratio`` times the word's own, else null."""
    both = F.array(F.struct(F.col("x").alias("word"), F.col("y").alias("other"), F.col("ny").alias("m")),
                   F.struct(F.col("y").alias("word"), F.col("x").alias("other"), F.col("nx").alias("m")))
    best = (near_pairs(words).select(F.explode(both).alias("p")).select("p.*").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best")))
    joined = words.select("word", "n").join(best, "word", "left")
    found = -F.col("best.m") >= ratio * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(found, F.col("best.other")).alias("form"), F.when(found, -F.col("best.m")).alias("form_n"))


def group_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every row of ``words``.

    ``words`` has distinct ``word`` and ``n``, its frequency; extra columns are
    ignored, null words have no near words and no root.  ``root`` is the last
    word on the way from a word to its form, that word's form, and so on (the
    word itself without a form).  With a ratio above 1 frequencies grow along
    the way, so it ends; it is followed by pointer doubling, whose rounds are
    the logarithm of the longest way.  An empty table gives an empty one.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    tmp = Scratch(words.sparkSession, "variants")
    own = tmp.save(words.select("word", "n"), "words")
    forms = tmp.save(near_forms(own, ratio), "forms")
    ways = tmp.save(forms.where("form is not null").select("word", F.col("form").alias("up")), "ways0")
    k = 0
    while True:
        above = ways.select(F.col("word").alias("up"), F.col("up").alias("top"))
        step = tmp.save(ways.join(above, "up", "left").select("word", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), f"ways{k + 1}")
        more = step.where("moved").limit(1).count()
        tmp.drop(f"ways{k}")
        ways, k = step.select("word", "up"), k + 1
        if not more:
            break
    return (forms.join(ways, "word", "left")
                 .select("word", "n", "n_near", "form", "form_n", F.coalesce("up", "word").alias("root")))
